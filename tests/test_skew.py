"""Hot keys: one player / one value holding a third of all rows."""

import contextlib

from pyspark.sql import functions as F

from seasonlab.operators.aggregate import season_totals
from seasonlab.operators.ranking import ranked


@contextlib.contextmanager
def conf(spark, **settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def hot_weekly(spark, n=3000):
    # player 0 holds a third of all rows
    return (spark.range(n).select(
        F.lit(2000).cast("long").alias("season"), (F.col("id") % 52).alias("week"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("player_id"),
        F.lit("name").alias("player_display_name"), F.lit("RB").alias("position"),
        (F.col("id") % 7).cast("double").alias("pts")))


def test_hot_player_is_pre_aggregated(spark):
    out = season_totals(hot_weekly(spark), points_col="pts")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_sum") > plan.index("Exchange")  # partial aggregate sits below the shuffle
    hot = out.where("player_id = 0").collect()[0]
    assert hot["games_in_data"] == 1000


def test_hot_value_rank_join_is_split_and_exact(spark):
    df = spark.range(6000).select(F.lit("RB").alias("g"), F.col("id"),
                                  F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.col("id").cast("double")).alias("v"))
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
                        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
                        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
                        "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        out = ranked(df, value_col="v", group_cols=["g"], out_col="r", method="average", partitions=8)
        got = {r["id"]: r["r"] for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    # 2001 rows tie at 5.0 (ids 0, 3, 6, ... and id 5); values 1, 2, 4 are below,
    # so the tie block's mid-rank is 3 + (2001 + 1) / 2
    assert got[0] == got[5] == 1004.0
    assert got[1] == 1.0 and got[7] == 3 + 2001 + 1  # the first value above the block
