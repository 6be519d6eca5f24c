"""Weekly rows -> season totals.

One ``groupBy`` with partial (map-side) aggregation: each map task folds its
rows into one row per key before the shuffle, so a player or season holding
a third of the rows still ships one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonlab.functions.columns import require_columns

WEEKLY_ID_COLUMNS = ("player_id", "player_display_name", "position", "season", "week")
SEASON_KEY = ("season", "player_id", "player_display_name", "position")
# Optional counting stats -> output names (left out when the input lacks them).
OPTIONAL_SUMS = (("carries", "carries_sum"), ("targets", "targets_sum"), ("attempts", "pass_attempts_sum"))


def validate_weekly_schema(df: DataFrame) -> None:
    require_columns(df, WEEKLY_ID_COLUMNS, "Weekly rows lack required id columns")


def sum_or_zero(df: DataFrame, column: str, alias: str) -> Column:
    """Aggregate: absent -> 0.0; else the null-as-zero double sum."""
    if column not in df.columns:
        return F.lit(0.0).alias(alias)
    return F.sum(F.coalesce(F.col(column).cast("double"), F.lit(0.0))).alias(alias)


def sum_nulls_as_zero(column: str, alias: str) -> Column:
    """Plain sum in the column's own type, but an all-null group gives 0."""
    return F.coalesce(F.sum(F.col(column)), F.lit(0)).alias(alias)


def season_totals(weekly: DataFrame, *, points_col: str = "fantasy_points_calc",
                  out_points_col: str = "season_fantasy_points") -> DataFrame:
    """One row per (season, player_id, player_display_name, position).

    Points sum, ``games_in_data`` (non-null ids), optional counting-stat sums
    and the max of an optional ``age`` column.
    """
    validate_weekly_schema(weekly)
    require_columns(weekly, [points_col], f"Points column not found (columns: {weekly.columns})")
    aggs = [
        F.coalesce(F.sum(F.col(points_col)), F.lit(0.0)).alias(out_points_col),
        F.count(F.col("player_id")).alias("games_in_data"),
    ]
    aggs += [sum_nulls_as_zero(src, out) for src, out in OPTIONAL_SUMS if src in weekly.columns]
    if "age" in weekly.columns:
        aggs.append(F.max("age").alias("age"))
    return weekly.groupBy(*SEASON_KEY).agg(*aggs)
