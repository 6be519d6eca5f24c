"""Supervised set (season t -> t+1) and time-based splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonlab.functions.columns import require_columns


def build_next_season_dataset(features: DataFrame, *, season_col: str = "season", player_id_col: str = "player_id",
                              position_col: str = "position", target_col: str = "feat_points",
                              out_target_col: str = "target_next_season_points") -> DataFrame:
    """Each season-t row with the same player's season t+1 value as the target.

    An equi join on (player, position, season): a player missing the next
    season, or changing position, has no row; duplicate next-season rows fan
    out; a next season without a value gives a null target; null keys never
    match. Seasons may be text. The right side carries its keys and the value
    only, and a skewed player's partitions are split by the join. Both sides read
    ``features``: hand over a written table (``session.materialize``), or what led to it runs twice.
    """
    keys = [player_id_col, position_col]
    require_columns(features, [season_col, *keys, target_col])
    before = (F.col(season_col).cast("bigint") - 1).alias("_t")
    values = features.select(*keys, before, F.col(target_col).alias(out_target_col))
    pairs = features.withColumn("_t", F.col(season_col).cast("bigint")).join(values, [*keys, "_t"])
    return pairs.select(*features.columns, out_target_col)


def is_train(season_col: str, train_end_season: int) -> Column:
    """True for train rows, False for test rows, null for a null season."""
    return F.col(season_col) <= F.lit(train_end_season)


def time_split(df: DataFrame, *, season_col: str = "season", train_end_season: int) -> tuple[DataFrame, DataFrame]:
    """(train: season <= T, test: season > T); null seasons are in neither."""
    require_columns(df, [season_col])
    return (df.where(F.col(season_col) <= F.lit(train_end_season)),
            df.where(F.col(season_col) > F.lit(train_end_season)))


def split_seasons(df: DataFrame, *, season_col: str = "season", train_end_season: int) -> DataFrame:
    """Distinct seasons of each side of the split: (split, season), one row each."""
    require_columns(df, [season_col])
    return (df.where(F.col(season_col).isNotNull()).select(season_col).distinct()
            .select(F.when(is_train(season_col, train_end_season), F.lit("train")).otherwise(F.lit("test")).alias("split"),
                    F.col(season_col).alias("season")))
