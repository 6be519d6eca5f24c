import pytest

from seasonlab.operators.dataset import build_next_season_dataset, split_seasons, time_split

from conftest import rows

SCHEMA = "season long, player_id string, position string, feat_points double, feat_ppg double"


def test_next_season_pairs(spark):
    df = spark.createDataFrame([(1999, "ann", "TE", 31.0, 3.1), (2000, "ann", "TE", 44.5, 4.0), (2000, "bob", "TE", 7.0, 7.0)], SCHEMA)
    out = build_next_season_dataset(df)
    assert rows(out, "season", "player_id", "feat_points", "target_next_season_points") == [(1999, "ann", 31.0, 44.5)]
    assert out.columns == [*df.columns, "target_next_season_points"]


def test_next_season_null_target_stays(spark):
    df = spark.createDataFrame([(2020, "p", "K", 1.0, 1.0), (2021, "p", "K", None, 1.0), (2022, "p", "K", 3.0, 1.0)], SCHEMA)
    out = {r["season"]: r["target_next_season_points"] for r in build_next_season_dataset(df).collect()}
    assert out == {2020: None, 2021: 3.0}


def test_next_season_of_text_seasons(spark):
    df = spark.createDataFrame([("2020", "p", "K", 1.0, 1.0), ("2021", "p", "K", 2.0, 1.0)], SCHEMA.replace("season long", "season string"))
    assert rows(build_next_season_dataset(df), "season", "target_next_season_points") == [("2020", 2.0)]


def test_next_season_position_change_and_gap(spark):
    df = spark.createDataFrame([(2023, "p1", "RB", 1.0, 1.0), (2024, "p1", "WR", 2.0, 2.0), (2026, "p1", "WR", 3.0, 3.0)], SCHEMA)
    assert build_next_season_dataset(df).count() == 0


def test_next_season_missing_column(spark):
    df = spark.createDataFrame([(2024, "p1", "RB", 1.0, 1.0)], SCHEMA)
    with pytest.raises(ValueError, match="feat_points"):
        build_next_season_dataset(df.drop("feat_points"))


def test_time_split(spark):
    df = spark.createDataFrame([(2024,), (2025,), (2026,), (None,)], "season long")
    train, test = time_split(df, train_end_season=2025)
    assert rows(train, "season") == [(2024,), (2025,)] and rows(test, "season") == [(2026,)]
    assert rows(split_seasons(df, train_end_season=2025), "split", "season") == [("test", 2026), ("train", 2024), ("train", 2025)]
    with pytest.raises(ValueError):
        time_split(df, season_col="year", train_end_season=2025)


def test_next_season_matches_brute_force(spark):
    import random

    rnd = random.Random(5)
    data = [(rnd.choice([2020, 2021, 2022, 2023, None]), rnd.choice(["p1", "p2", "p3", None]), rnd.choice(["RB", "WR"]),
             float(rnd.randint(0, 9)), float(i)) for i in range(120)]
    df = spark.createDataFrame(data, SCHEMA)
    want = sorted((*a, b[3]) for a in data for b in data
                  if None not in (a[0], a[1]) and (a[1], a[2]) == (b[1], b[2]) and b[0] == a[0] + 1)
    assert rows(build_next_season_dataset(df), *df.columns, "target_next_season_points") == want


def test_drop_nulls_keeps_nan(spark):
    from seasonlab.functions.columns import drop_nulls
    df = spark.createDataFrame([(1, float("nan"), 1.0), (2, None, 1.0), (3, 1.0, None), (4, 2.0, 2.0)], "id long, a double, b double")
    assert rows(drop_nulls(df, ["a", "b"]), "id") == [(1,), (4,)]
    assert rows(drop_nulls(df, ["a"]), "id") == [(1,), (3,), (4,)]
    assert df.na.drop(subset=["a", "b"]).count() == 1  # Spark's own na.drop also drops NaN
