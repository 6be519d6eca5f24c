import random

import pandas as pd
import pytest

from seasonlab.operators.evaluation import spearman_rank_by_position
from seasonlab.operators.ranking import average_rank, first_n_per_group, top_n_by_position, with_dense_rank

from conftest import rows


def players(spark, data):
    return spark.createDataFrame(data, "player string, position string, fantasy_points double")


def test_top_n_filters_positions_and_ranks(spark):
    df = players(spark, [("north", "TE", 3.5), ("south", "TE", 7.25), ("east", "DST", 1.0), ("west", "DST", -4.0), ("snapper", "LS", 80.0)])
    out = top_n_by_position(df, n=1)
    assert {r["player"] for r in out.collect()} == {"south", "east"}
    assert out.columns == df.columns


def test_top_n_ties_share_rank_and_nulls_drop(spark):
    df = players(spark, [("a", "QB", 20.0), ("b", "QB", 20.0), ("c", "QB", 10.0), ("d", "QB", None)])
    assert {r["player"] for r in top_n_by_position(df, n=1).collect()} == {"a", "b"}
    assert {r["player"] for r in top_n_by_position(df, n=5).collect()} == {"a", "b", "c"}


def test_top_n_output_sorted(spark):
    df = players(spark, [("a", "RB", 1.0), ("b", "QB", 2.0), ("c", "QB", 3.0), ("d", "RB", 4.0)])
    assert [r["player"] for r in top_n_by_position(df, n=5).collect()] == ["c", "b", "d", "a"]


def test_top_n_validates(spark):
    df = players(spark, [("a", "QB", 1.0)])
    with pytest.raises(ValueError):
        top_n_by_position(df.drop("position"))
    with pytest.raises(ValueError):
        top_n_by_position(df.drop("fantasy_points"))
    for n in (0, -1, 1.5, True):
        with pytest.raises(ValueError):
            top_n_by_position(df, n=n)


def test_top_n_plan_limits_before_shuffle(spark):
    df = players(spark, [(str(i), "QB", float(i)) for i in range(50)])
    plan = top_n_by_position(df, n=3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_dense_rank_column(spark):
    df = players(spark, [("a", "QB", 20.0), ("b", "QB", 20.0), ("c", "QB", 10.0)])
    assert rows(with_dense_rank(df), "player", "rank") == [("a", 1), ("b", 1), ("c", 2)]


def test_first_n_exact_with_tiebreak(spark):
    df = spark.createDataFrame([("g", 5.0, "x"), ("g", 5.0, "a"), ("g", 1.0, "b")], "g string, v double, player_id string")
    out = first_n_per_group(df, group_col="g", order_col="v", n=1, tiebreak=["player_id"])
    assert rows(out, "player_id") == [("a",)]


@pytest.mark.parametrize("partitions", [1, 7, 60, None])
def test_average_rank_matches_brute_force(spark, partitions):
    rnd = random.Random(7)
    data = [(rnd.choice("ABC"), float(rnd.randint(0, 12)) if rnd.random() > 0.1 else None, i) for i in range(300)]
    df = spark.createDataFrame(data, "g string, v double, id long")
    got = {r["id"]: r["r"] for r in average_rank(df, value_col="v", group_cols=["g"], out_col="r",
                                                 partitions=partitions).collect()}
    pdf = pd.DataFrame(data, columns=["g", "v", "id"])
    pdf["r"] = pdf.groupby("g")["v"].rank(method="average")
    for _, row in pdf.iterrows():
        if pd.isna(row["r"]):
            assert got[row["id"]] is None
        else:
            assert got[row["id"]] == pytest.approx(row["r"])


def test_average_rank_without_groups(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (3.0,), (2.0,)], "v double")
    out = average_rank(df, value_col="v", partitions=3)
    assert sorted(r["avg_rank"] for r in out.collect()) == [1.5, 1.5, 3.0, 4.0] and out.columns == ["v", "avg_rank"]


def test_spearman_matches_brute_force(spark):
    rnd = random.Random(3)
    data = [(rnd.choice(["RB", "WR"]), float(rnd.randint(0, 30)), float(rnd.randint(0, 30))) for _ in range(200)]
    df = spark.createDataFrame(data, "position string, y_true double, y_pred double")
    pdf = pd.DataFrame(data, columns=["position", "a", "b"])
    got = {r["position"]: r["spearman"] for r in spearman_rank_by_position(df).collect()}
    for pos, grp in pdf.groupby("position"):
        assert got[pos] == pytest.approx(grp["a"].rank().corr(grp["b"].rank()), abs=1e-12)


@pytest.mark.parametrize("method,pandas_method", [("average", "average"), ("min", "min"), ("dense", "dense")])
@pytest.mark.parametrize("descending", [False, True])
def test_rank_methods_match_brute_force(spark, method, pandas_method, descending):
    from seasonlab.operators.ranking import ranked
    rnd = random.Random(11)
    data = [(rnd.choice("AB"), float(rnd.randint(-5, 8)) if rnd.random() > 0.1 else None, i) for i in range(150)]
    df = spark.createDataFrame(data, "g string, v double, id long")
    got = {r["id"]: r["r"] for r in ranked(df, value_col="v", group_cols=["g"], out_col="r", method=method,
                                            descending=descending, partitions=5).collect()}
    pdf = pd.DataFrame(data, columns=["g", "v", "id"])
    pdf["r"] = pdf.groupby("g")["v"].rank(method=pandas_method, ascending=not descending)
    for i, r in zip(pdf["id"], pdf["r"]):
        assert got[i] is None if pd.isna(r) else got[i] == pytest.approx(r)


def test_a_group_over_many_partitions(spark):
    """One group's values lie in 40 ranges, the other's in one; the prefix sums join them up."""
    from pyspark.sql import functions as F

    from seasonlab.operators.ranking import rank_table
    df = spark.range(4000).select(F.when(F.col("id") < 3990, "big").alias("g"), ((F.col("id") * 7919) % 1000).cast("double").alias("v"))
    for method, window in (("average", None), ("min", "rank"), ("dense", "dense_rank")):
        got = {(r["g"], r["_v"]): r["avg_rank"] for r in rank_table(df, value_col="v", group_cols=["g"], method=method, partitions=40).collect()}
        pdf = df.toPandas()
        pdf["r"] = pdf.groupby("g", dropna=False)["v"].rank(method=method)
        assert got == {(None if pd.isna(g) else g, v): r for g, v, r in zip(pdf["g"], pdf["v"], pdf["r"])}, window


def test_rank_cost_is_flat_in_the_number_of_ranges(spark):
    """Plans hold no per-range array: a row's expressions are the same for 10 and for 2,000 ranges."""
    from seasonlab.operators.ranking import rank_table
    df = spark.range(6000).selectExpr("cast(id % 3001 as double) AS v")
    few, many = (rank_table(df, value_col="v", partitions=n) for n in (10, 2000))
    steps = [t._jdf.queryExecution().sparkPlan().toString() for t in (few, many)]
    assert all("percentile" not in p and "filter(" not in p for p in steps) and len(steps[0].splitlines()) == len(steps[1].splitlines())
    assert rows(few, "_v", "avg_rank") == rows(many, "_v", "avg_rank") and few.count() == 3001


def test_null_groups_rank_on_their_own(spark):
    from seasonlab.operators.ranking import ranked
    df = spark.createDataFrame([(None, 2.0), (None, 1.0), ("a", 5.0), ("a", None)], "g string, v double")
    assert sorted(((r["g"] or "", r["v"] or 0.0, r["rank"]) for r in ranked(df, value_col="v", group_cols=["g"]).collect()), key=str) == [
        ("", 1.0, 1.0), ("", 2.0, 2.0), ("a", 0.0, None), ("a", 5.0, 1.0)]


def test_ranks_agree_with_windows_on_testbed(spark, sf_small):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from seasonlab.operators.ranking import ranked
    from seasonlab.plans import queries as q
    t = q.exact(q.totals(spark, sf_small).select("season", "player_id", "position", "season_fantasy_points"), "season_fantasy_points")
    got = ranked(t, value_col="season_fantasy_points", group_cols=["position"], out_col="r", method="dense", descending=True, partitions=13)
    w = Window.partitionBy("position").orderBy(F.col("season_fantasy_points").desc())
    want = t.withColumn("r", F.dense_rank().over(w).cast("long"))
    assert rows(got, "season", "player_id", "r") == rows(want, "season", "player_id", "r") and want.count() > 100


def test_values_a_hair_apart_are_no_ties(spark):
    df = spark.createDataFrame([("QB", 1e-10, -3e-10), ("QB", 2e-10, -1e-10), ("QB", 3e-10, -2e-10)], "position string, fantasy_points double, other double")
    assert [r["r"] for r in average_rank(df, value_col="fantasy_points", group_cols=["position"], out_col="r").orderBy("fantasy_points").collect()] == [1.0, 2.0, 3.0]
    assert top_n_by_position(df, n=1).count() == 1
    sp = spearman_rank_by_position(df, actual_col="fantasy_points", pred_col="other").collect()[0]["spearman"]
    assert sp == pytest.approx(0.5)


def test_nan_is_the_largest_everywhere(spark):
    df = players(spark, [("a", "QB", float("nan")), ("b", "QB", 2.0), ("c", "QB", 1.0)])
    assert rows(with_dense_rank(df), "player", "rank") == [("a", 1), ("b", 2), ("c", 3)]
    assert [r["player"] for r in top_n_by_position(df, n=1).collect()] == ["a"]
    up = average_rank(df, value_col="fantasy_points", group_cols=["position"], out_col="r")
    assert rows(up, "player", "r") == [("a", 3.0), ("b", 2.0), ("c", 1.0)]


def test_a_position_of_ties_needs_no_row_window(spark):
    from pyspark.sql import functions as F
    df = spark.range(20_000).select(F.col("id").cast("string").alias("player"), F.when(F.col("id") >= 0, "QB").alias("position"), (F.col("id") % 10).cast("double").alias("fantasy_points"))
    out = top_n_by_position(df, n=24)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 20_000 and top_n_by_position(df, n=3).count() == 6_000
    window = plan[plan.index("Window ["):]
    assert "HashAggregate(keys=[position" in window  # the window ranks distinct values


def test_ungrouped_rank_has_no_cross_join(spark):
    from seasonlab.operators.ranking import rank_table
    df = spark.createDataFrame([(float(v),) for v in (3, 1, 2, 2, 5, 8, 8, 8)], "v double")
    t = rank_table(df, value_col="v", partitions=3)
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert {r["_v"]: r["avg_rank"] for r in t.collect()} == {1.0: 1.0, 2.0: 2.5, 3.0: 4.0, 5.0: 5.0, 8.0: 7.0}
