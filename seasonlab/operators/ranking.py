"""Ranking operators: top-N per position and exact full ranks (average, min, dense).

Values are compared as they are: no rounding, and NaN is the largest value (so
it comes first when the highest rank first), as in Spark's own ordering.

No operator sorts a whole group in one task. Top-N by dense rank looks up each
position's N-th highest distinct value and filters by it; full ranks come from
``rank_table``: values sorted into range partitions, and prefix sums over these.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seasonlab.functions.columns import require_columns
from seasonlab.session import materialize

# Positions kept by the ranking, and by the weekly pipelines.
RANKING_POSITIONS = ("QB", "RB", "WR", "TE", "K", "DST")
PLAYER_POSITIONS = ("QB", "RB", "WR", "TE", "K")

RANK_METHODS = ("average", "min", "dense")


def filter_positions(df: DataFrame, positions=PLAYER_POSITIONS, *, position_col: str = "position") -> DataFrame:
    return df.where(F.col(position_col).isin(list(positions)))


def with_dense_rank(df: DataFrame, *, position_col: str = "position", points_col: str = "fantasy_points",
                    out_col: str = "rank") -> DataFrame:
    """Dense rank of points, highest first, within each position; rows with null points are dropped."""
    require_columns(df, [position_col, points_col])
    out = ranked(df.where(F.col(points_col).isNotNull()), value_col=points_col, group_cols=[position_col],
                 out_col=out_col, method="dense", descending=True)
    return out.withColumn(out_col, F.col(out_col).cast("long"))


def nth_highest_values(df: DataFrame, *, position_col: str, points_col: str, n: int) -> DataFrame:
    """(position, ``_least``): each position's n-th highest distinct value (its lowest, if it has fewer).

    Distinct values only: the row limit keeps at most n of them per task and
    position before they meet, so ties cost nothing.
    """
    values = df.select(position_col, points_col).distinct()
    best = Window.partitionBy(position_col).orderBy(F.col(points_col).desc())
    top = values.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= n)
    return top.groupBy(position_col).agg(F.min(points_col).alias("_least"))


def top_n_by_position(df: DataFrame, *, position_col: str = "position", points_col: str = "fantasy_points",
                      n: int = 24, positions=RANKING_POSITIONS) -> DataFrame:
    """Rows whose dense rank of points within their position is <= n.

    Ties share a rank, so a position can return more than n rows. Rows with
    null points are dropped; positions outside ``positions`` are dropped.
    Output keeps the input columns, sorted by position asc, points desc, then
    by the other columns, so that equal points still spread over the sort's
    range partitions.
    """
    require_columns(df, [position_col, points_col])
    if isinstance(n, bool) or not isinstance(n, int) or n <= 0:
        raise ValueError(f"n must be an integer >= 1 (got {n!r})")
    scoped = filter_positions(df, positions, position_col=position_col).where(F.col(points_col).isNotNull())
    least = nth_highest_values(scoped, position_col=position_col, points_col=points_col, n=n)
    # one row per listed position, so broadcasting it is bounded by the caller's list
    top = scoped.join(F.broadcast(least), [position_col]).where(F.col(points_col) >= F.col("_least"))
    rest = [F.col(f.name).asc() for f in df.schema.fields
            if f.name not in (position_col, points_col) and f.dataType.typeName() not in ("map", "variant")]
    return top.select(*df.columns).orderBy(F.col(position_col).asc(), F.col(points_col).desc(), *rest)


def first_n_per_group(df: DataFrame, *, group_col: str, order_col: str, n: int,
                      tiebreak: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Exactly the first n rows per group by ``order_col`` desc (then ``tiebreak``)."""
    order = [F.col(order_col).desc()] + [F.col(c).asc() for c in tiebreak]
    w = Window.partitionBy(group_col).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def rank_table(df: DataFrame, *, value_col: str, group_cols: list[str] | tuple[str, ...] = (),
               out_col: str = "avg_rank", method: str = "average", descending: bool = False,
               partitions: int | None = None) -> DataFrame:
    """Distinct (group, value) -> exact rank of that value within the group.

    ``method``: ``average`` (mid-rank of ties), ``min`` (SQL ``rank``) or
    ``dense`` (SQL ``dense_rank``); ``descending`` ranks the highest first.

    A plain rank window would sort every group inside one task. Instead:

    1. count rows per distinct (group, value)                 -- partial aggregate
    2. sort them by (group, value) into range partitions, written once
    3. running counts inside each (group, partition)          -- window, many tasks
    4. one total a (group, partition), and the running sum of those before it
    5. rank from the counts before the value and its tie count

    A group may lie in any number of partitions, and a row costs the same
    however many there are. A hot value is a single row after step 1; a null
    group is a group of its own. ``partitions`` sets how many ranges there are
    (default: as the session shuffles; small ones are joined at run time).
    Output columns: group columns, ``_v`` (the value), ``out_col``.
    """
    if method not in RANK_METHODS:
        raise ValueError(f"method must be one of {RANK_METHODS}")
    g = list(group_cols)
    counts = (df.select(*g, F.col(value_col).alias("_v")).where(F.col("_v").isNotNull())
              .groupBy(*g, "_v").agg(F.count(F.lit(1)).alias("_c")))
    first = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    order = [*(F.col(c) for c in g), first("_v")]
    placed = counts.repartitionByRange(*([partitions] if partitions else []), *order)
    # written, as a value must keep its partition in both passes below and in a retry
    placed = materialize(placed.withColumn("_p", F.spark_partition_id()))
    within = Window.partitionBy(*g, "_p").orderBy(first("_v")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = placed.withColumns({"_cum": F.sum("_c").over(within), "_cum_d": F.count(F.lit(1)).over(within)})
    totals = placed.groupBy(*g, "_p").agg(F.sum("_c").alias("_t"), F.count(F.lit(1)).alias("_d"))
    before = Window.partitionBy(*g).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*(F.col(c).alias(f"_g_{c}") for c in g), F.col("_p").alias("_q"),
                           F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"),
                           F.coalesce(F.sum("_d").over(before), F.lit(0)).alias("_off_d"))
    same = F.col("_p") == F.col("_q")
    for c in g:
        same = same & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    rows_before = F.col("_off") + F.col("_cum") - F.col("_c")
    rank = {
        "average": rows_before + (F.col("_c") + 1) / 2.0,
        "min": rows_before + 1,
        "dense": F.col("_off_d") + F.col("_cum_d"),
    }[method]
    return running.join(totals, same).select(*g, "_v", rank.alias(out_col))


def ranked(df: DataFrame, *, value_col: str, group_cols: list[str] | tuple[str, ...] = (), out_col: str = "rank",
           method: str = "average", descending: bool = False, partitions: int | None = None) -> DataFrame:
    """``df`` plus the exact rank of ``value_col`` within each group (null value -> null rank).

    Ranks from ``rank_table`` are joined back on (group, value): the join
    streams the row side, and a partition skewed by one value's many rows is
    split. A null group is a group of its own.
    """
    g = list(group_cols)
    ranks = rank_table(df, value_col=value_col, group_cols=g, out_col=out_col, method=method, descending=descending,
                       partitions=partitions)
    left, right = df.alias("_l"), ranks.alias("_r")
    same = F.col(f"_l.{value_col}") == F.col("_r._v")
    for c in g:
        same = same & F.col(f"_l.{c}").eqNullSafe(F.col(f"_r.{c}"))
    return left.join(right, same, "left").select("_l.*", F.col(f"_r.{out_col}").alias(out_col))


def average_rank(df: DataFrame, *, value_col: str, group_cols: list[str] | tuple[str, ...] = (),
                 out_col: str = "avg_rank", partitions: int | None = None) -> DataFrame:
    """``df`` plus the mid-rank of ``value_col`` within each group (ties share the average)."""
    return ranked(df, value_col=value_col, group_cols=group_cols, out_col=out_col, method="average",
                  partitions=partitions)
