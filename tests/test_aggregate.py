import pytest
from pyspark.sql import functions as F

from seasonlab.operators.aggregate import season_totals, sum_nulls_as_zero, sum_or_zero

from conftest import rows

WEEKLY = "season long, week long, player_id string, player_display_name string, position string, fp double, targets long, carries long, attempts long"


def weekly(spark):
    return spark.createDataFrame([
        (2025, 1, "p1", "A", "RB", 10.0, 2, 10, 0),
        (2025, 2, "p1", "A", "RB", 5.0, 1, 12, 0),
        (2025, 1, "p2", "B", "WR", 7.0, 0, 8, 0),
    ], WEEKLY)


def test_sum_or_zero_null_safe(spark):
    df = spark.createDataFrame([(1, 3), (1, None), (2, 5)], "player_id long, targets long")
    assert rows(df.groupBy("player_id").agg(sum_or_zero(df, "targets", "t")), "player_id", "t") == [(1, 3.0), (2, 5.0)]
    no_col = df.drop("targets")
    assert rows(no_col.groupBy("player_id").agg(sum_or_zero(no_col, "targets", "t")), "player_id", "t") == [(1, 0.0), (2, 0.0)]


def test_all_null_sum_is_zero(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 4)], "k long, x long")
    assert rows(df.groupBy("k").agg(sum_nulls_as_zero("x", "s")), "k", "s") == [(1, 0), (2, 4)]


def test_season_totals(spark):
    out = season_totals(weekly(spark), points_col="fp", out_points_col="pts")
    got = {r["player_id"]: r for r in out.collect()}
    assert got["p1"]["pts"] == 15.0 and got["p2"]["pts"] == 7.0
    assert (got["p1"]["games_in_data"], got["p1"]["targets_sum"], got["p1"]["carries_sum"], got["p1"]["pass_attempts_sum"]) == (2, 3, 22, 0)
    assert "age" not in out.columns


def test_season_totals_optional_columns(spark):
    df = weekly(spark).drop("targets", "attempts").withColumn("age", F.when(F.col("week") == 1, F.lit(27.0)))
    out = season_totals(df, points_col="fp")
    assert "targets_sum" not in out.columns and "pass_attempts_sum" not in out.columns
    assert rows(out, "player_id", "age") == [("p1", 27.0), ("p2", 27.0)]


def test_season_totals_schema_errors(spark):
    with pytest.raises(ValueError, match="week"):
        season_totals(weekly(spark).drop("week"), points_col="fp")
    with pytest.raises(ValueError, match="not found"):
        season_totals(weekly(spark), points_col="missing")


def test_season_totals_partial_aggregation(spark):
    plan = season_totals(weekly(spark), points_col="fp")._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan
