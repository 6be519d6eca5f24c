"""Regression metrics and correlation as single-pass aggregates.

Every metric here is an algebraic aggregate (count, sums, co-moments), so
Spark folds it map-side before the shuffle: a group with a third of all rows
costs one partial row per task. A pair with a null on either side has no
error: all parts of a metric are taken over the pairs without one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonlab.functions.columns import require_columns


def _nan() -> Column:
    return F.lit(float("nan"))


def _pair(a: str, b: str) -> tuple[Column, Column]:
    """Both columns, null where either is."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    return F.when(both, F.col(a)), F.when(both, F.col(b))


def _r2(n: Column, ss_res: Column, ss_tot: Column) -> Column:
    """1 - SSres / SStot; NaN when n < 2; with constant actuals 1.0 for a perfect prediction, else 0.0."""
    return (F.when(n < 2, _nan())
            .when(ss_tot == 0, F.when(ss_res == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
            .otherwise(F.lit(1.0) - ss_res / ss_tot))


def metric_columns(actual_col: str, pred_col: str, *, n_alias: str | None = "n") -> list[Column]:
    """MAE, RMSE and R^2 over the (actual, prediction) pairs without a null; ``n`` counts these pairs.

    SStot = n * var_pop(actual) (stable).
    """
    y, p = _pair(actual_col, pred_col)
    err = y - p
    n = F.count(err)
    r2 = _r2(n, F.sum(err * err), F.var_pop(y) * n)
    cols = [F.avg(F.abs(err)).alias("mae"), F.sqrt(F.avg(err * err)).alias("rmse"), r2.alias("r2")]
    if n_alias:
        cols.insert(0, n.alias(n_alias))
    return cols


def regression_metrics(df: DataFrame, *, actual_col: str = "y_true", pred_col: str = "y_pred",
                       group_cols: Sequence[str] = ()) -> DataFrame:
    """One metrics row per group (or one row overall): n, mae, rmse, r2.

    Rows with a null actual or prediction have no error and are left out.
    """
    require_columns(df, [actual_col, pred_col, *group_cols])
    df = df.where(F.col(actual_col).isNotNull() & F.col(pred_col).isNotNull())
    cols = metric_columns(actual_col, pred_col)
    return df.groupBy(*group_cols).agg(*cols) if group_cols else df.agg(*cols)


def metrics_with_overall(df: DataFrame, *, group_col: str = "position", actual_col: str = "y_true",
                         pred_col: str = "y_pred", overall_label: str = "ALL") -> DataFrame:
    """Per-group metrics plus the overall row, last, from one aggregate over the rows.

    The overall row merges the groups' counts, sums, means and squared
    deviations (groups rows, in one task), so no row is aggregated twice.
    """
    require_columns(df, [actual_col, pred_col, group_col])
    y, p = _pair(actual_col, pred_col)
    err = (y - p).cast("double")
    groups = df.groupBy(F.col(group_col).alias("_g")).agg(
        F.count(err).alias("n"), F.coalesce(F.sum(F.abs(err)), F.lit(0.0)).alias("_abs"),
        F.coalesce(F.sum(err * err), F.lit(0.0)).alias("_sq"), F.coalesce(F.avg(y), F.lit(0.0)).cast("double").alias("_mean"),
        F.coalesce(F.var_pop(y) * F.count(err), F.lit(0.0)).alias("_dev"), F.lit(0).alias("_gid"))
    every = Window.partitionBy(F.lit(0))
    merged = groups.withColumn("_all", F.sum(F.col("n") * F.col("_mean")).over(every) / F.sum("n").over(every))
    overall = merged.agg(
        F.sum("n").alias("n"), F.sum("_abs").alias("_abs"), F.sum("_sq").alias("_sq"),
        F.sum(F.col("_dev") + F.col("n") * (F.col("_mean") - F.col("_all")) * (F.col("_mean") - F.col("_all"))).alias("_dev"))
    overall = overall.where(F.col("n").isNotNull()).select(
        F.lit(overall_label).alias("_g"), "n", "_abs", "_sq", F.lit(0.0).alias("_mean"), "_dev", F.lit(1).alias("_gid"))
    rows = groups.withColumn("_g", F.col("_g").cast("string")).unionByName(overall)
    mean_sq = F.when(F.col("n") > 0, F.col("_sq") / F.col("n"))
    return (rows.orderBy("_gid", "_g")
            .select(F.col("_g").alias(group_col), "n", F.when(F.col("n") > 0, F.col("_abs") / F.col("n")).alias("mae"),
                    F.sqrt(mean_sq).alias("rmse"), _r2(F.col("n"), F.col("_sq"), F.col("_dev")).alias("r2")))


def pearson_column(a: str, b: str) -> Column:
    """Pearson correlation of the pairs without a null; NaN for fewer than two or zero variance (never raises)."""
    x, y = _pair(a, b)
    denom = F.sqrt(F.var_pop(x) * F.var_pop(y))
    return F.when((F.count(x) < 2) | (denom == 0) | denom.isNull(), _nan()).otherwise(F.covar_pop(x, y) / denom)


def pearson_by_group(df: DataFrame, a: str, b: str, *, group_cols: Sequence[str] = (),
                     out_col: str = "pearson") -> DataFrame:
    """One row per group: n (pairs without a null) and the correlation."""
    require_columns(df, [a, b, *group_cols])
    cols = [F.count(_pair(a, b)[0]).alias("n"), pearson_column(a, b).alias(out_col)]
    return df.groupBy(*group_cols).agg(*cols) if group_cols else df.agg(*cols)
