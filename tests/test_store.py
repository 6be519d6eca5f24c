"""The season store, its refresh, the season feed, one-file CSV and the counts of a run."""

import pytest
from pyspark.sql import functions as F

from seasonlab.operators.dataset import build_next_season_dataset
from seasonlab.operators.features import build_season_features
from seasonlab.plans import pipelines as pl
from seasonlab.plans import queries as q
from seasonlab.sources import FeedSource, TestbedSource, WeeklyStore, derived_refresh, scratch_store, typed_weekly, write_csv, write_feed
from seasonlab.sources.feed import SeasonFeedReader
from seasonlab.sources.store import CO_PARTITIONED, season_fingerprints

from conftest import rows
from test_skew import conf


@pytest.fixture(scope="module")
def store(spark, sf_small):
    out = scratch_store(spark, "test-store", buckets=4)
    out.create(TestbedSource(spark, sf_small).load_weekly_seasons(None))
    return out


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_totals_and_pairs_need_no_exchange_on_the_player(spark, store):
    with conf(spark, **NO_BROADCAST, **CO_PARTITIONED):
        totals = pl.scored_season_totals(store.read())
        assert "Exchange" not in plan(totals) and "Bucketed: true" in plan(totals)
        pairs = build_next_season_dataset(build_season_features(totals))
        assert "Exchange" not in plan(pairs) and "SortMergeJoin" in plan(pairs) and pairs.count() > 0


def test_a_season_is_a_partition_filter(spark, store, sf_small):
    one = store.read([2000])
    assert "PartitionFilters: [isnotnull(season" in plan(one) and one.count() == TestbedSource(spark, sf_small).load_weekly_player_stats(2000).count()


def test_refresh_replaces_changed_seasons_only(spark, sf_small):
    weekly = TestbedSource(spark, sf_small).load_weekly_seasons(None)
    store, totals = scratch_store(spark, "refresh", buckets=2), scratch_store(spark, "refresh-totals", buckets=2)
    store.create(weekly)
    derived_refresh(store, totals, pl.scored_season_totals, [])
    files = {r[0] for r in store.read().select(F.input_file_name()).distinct().collect()}
    # the same rows in another order and with the columns turned round
    assert store.refresh(weekly.where("season IN (1998, 1999)").select(*reversed(weekly.columns)).orderBy(F.rand(1))) == []
    assert {r[0] for r in store.read().select(F.input_file_name()).distinct().collect()} == files
    fixed = weekly.where("season IN (1998, 1999)").withColumn("receptions", F.col("receptions") + (F.col("season") == 1999).cast("int"))
    assert store.changed_seasons(fixed) == [1999]
    changed = store.refresh(fixed)
    assert changed == [1999] and store.refresh(fixed) == []
    derived_refresh(store, totals, pl.scored_season_totals, changed)
    after = {r[0] for r in store.read().select(F.input_file_name()).distinct().collect()}
    assert {f for f in files - after} == {f for f in files if "season=1999" in f} and {f for f in after - files} == {f for f in after if "season=1999" in f}
    whole = pl.scored_season_totals(weekly.where("season <> 1999").unionByName(fixed.where("season = 1999")))
    columns = sorted(whole.columns)
    assert q.round_doubles(totals.read()).select(columns).exceptAll(q.round_doubles(whole).select(columns)).count() == 0 and totals.read().count() == whole.count()
    with pytest.raises(ValueError, match="lacks"):
        store.refresh(fixed.drop("receptions"))
    with pytest.raises(ValueError, match="without a season"):
        store.refresh(fixed.withColumn("season", F.when(F.col("season") > 1998, F.col("season"))))
    with pytest.raises(ValueError, match="table name"):
        WeeklyStore(spark, "a; drop table b")


def test_fingerprints_see_null_patterns(spark):
    a, b = (spark.createDataFrame([(1, x, y)], "season long, x string, y string") for x, y in ((None, "v"), ("v", None)))
    assert rows(season_fingerprints(a), "a", "b") != rows(season_fingerprints(b), "a", "b")


def test_feed_opens_the_wanted_seasons_only(spark, sf_small, tmp_path):
    weekly = TestbedSource(spark, sf_small).load_weekly_seasons(None)
    folder = str(tmp_path / "feed")
    assert write_feed(weekly.repartition(3), folder) >= 7
    source = FeedSource(spark, folder, weekly.schema)
    every = source.load_weekly_seasons(None)
    assert every.count() == weekly.count() and every.rdd.getNumPartitions() >= 7
    reader = SeasonFeedReader(weekly.schema, folder, "season")
    from pyspark.sql.datasource import EqualTo, GreaterThan, In
    left = list(reader.pushFilters([In(("season",), (1999, 2000)), GreaterThan(("week",), 3), EqualTo(("season",), 2000)]))
    assert [type(f) for f in left] == [GreaterThan] and {p.season for p in reader.partitions()} == {2000}
    for p in tmp_path.glob("feed/season=1997/*.arrows"):  # a season that must not be opened
        p.write_bytes(b"broken")
    one = source.load_weekly_player_stats(2000)
    columns = ["game_id", "player_id", "rushing_yards", "def_sacks", "position"]
    want = weekly.where("season = 2000").select(columns)
    assert one.select(columns).exceptAll(want).count() == 0 and one.count() == want.count()
    got = pl.build_baseline_top_n(source, season=2000, top_n=3)
    ref = pl.build_baseline_top_n(TestbedSource(spark, sf_small), season=2000, top_n=3)
    assert rows(q.round_doubles(got), "player_id", "fantasy_points") == rows(q.round_doubles(ref), "player_id", "fantasy_points")
    with pytest.raises(Exception):
        source.load_weekly_player_stats(1997).count()
    assert source.load_weekly_player_stats(1900).count() == 0


def test_one_csv_file_in_ranking_order(spark, sf_small, tmp_path):
    path = str(tmp_path / "ranking.csv")
    ranking = pl.build_baseline_top_n(TestbedSource(spark, sf_small), season=2000, top_n=3, out_path=path)
    lines = (tmp_path / "ranking.csv").read_text().splitlines()
    assert lines[0] == ",".join(ranking.columns) and len(lines) == 1 + ranking.count()
    at = ranking.columns.index("player_id")
    assert [int(line.split(",")[at]) for line in lines[1:]] == [r["player_id"] for r in ranking.collect()]
    assert [p.name for p in tmp_path.iterdir() if "parts" in p.name] == []
    write_csv(ranking.limit(1), path)
    assert len((tmp_path / "ranking.csv").read_text().splitlines()) == 2
    with pytest.raises(FileExistsError):
        write_csv(ranking, path, mode="error")
    with pytest.raises(ValueError):
        write_csv(ranking, path, mode="append")
    write_csv(ranking.limit(0), str(tmp_path / "none.csv"))
    assert (tmp_path / "none.csv").exists()


def test_statistics_are_told_by_whole_words(spark):
    df = spark.createDataFrame([("12", "en", "x.png", "3", "1.5", "2", "4")], "rushing_yards string, language string, image string, age string, fg_made string, def_fumble_recoveries string, week string")
    kinds = {f.name: f.dataType.simpleString() for f in typed_weekly(df).schema.fields}
    assert kinds == {"rushing_yards": "double", "language": "string", "image": "string", "age": "double", "fg_made": "double", "def_fumble_recoveries": "double", "week": "bigint"}


@pytest.mark.parametrize("how", ["checkpoint", "persist"])
def test_a_run_reports_its_counts(spark, sf_small, how):
    feats = q.features(spark, sf_small)
    res = pl.run_forecast(feats, train_end_season=1998, forecast_season=2001, materialization=how)
    assert res.age_coverage == pl.age_coverage(feats).first().asDict()
    assert res.dropped_rows == pl.dropped_rows_report(q.supervised(spark, sf_small)[0]).first().asDict()
    spark.catalog.clearCache()


def test_pairs_of_seasons_scan_line_items_once(spark, sf_small):
    for name in ("next_season_dataset", "drop_null_features", "time_split_train", "naive_metrics", "pearson_by_group", "dropped_rows_report"):
        before = plan(q.RAW_QUERIES[name](spark, sf_small))
        assert "l_orderkey" not in before, name  # both sides read the written feature table
    assert plan(q.features(spark, sf_small)).count("l_linenumber") > 0
    one = plan(q.features(spark, sf_small))
    assert one.count("FileScan parquet") == 4 and one.count("/lineitem.parquet") == 1
