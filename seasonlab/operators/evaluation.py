"""Slice metrics and rank correlation on a predictions table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonlab.functions.columns import require_columns
from seasonlab.operators.metrics import metric_columns, pearson_column
from seasonlab.operators.ranking import first_n_per_group, rank_table

DEFAULT_TIEBREAK = ("player_id", "season")


def _defined(df: DataFrame, actual_col: str, pred_col: str) -> DataFrame:
    # A null actual or prediction has no error; such rows are left out.
    return df.where(F.col(actual_col).isNotNull() & F.col(pred_col).isNotNull())


def _tiebreak(df: DataFrame, tiebreak: Sequence[str] | None) -> list[str]:
    cols = DEFAULT_TIEBREAK if tiebreak is None else tiebreak
    return [c for c in cols if c in df.columns]


def top_n_per_position_metrics(predictions: DataFrame, *, n: int = 24, position_col: str = "position",
                               actual_col: str = "y_true", pred_col: str = "y_pred",
                               tiebreak: Sequence[str] | None = None) -> DataFrame:
    """MAE/RMSE/R^2 on the n highest actuals of each position: position, n, mae, rmse, r2.

    Exactly n rows per position at most (ties cut by ``tiebreak``, default
    player_id then season). ``WindowGroupLimit`` keeps n rows per task and
    position before the shuffle.
    """
    require_columns(predictions, [position_col, actual_col, pred_col])
    top = first_n_per_group(_defined(predictions, actual_col, pred_col), group_col=position_col,
                            order_col=actual_col, n=n, tiebreak=_tiebreak(predictions, tiebreak))
    return (top.groupBy(F.col(position_col).alias("position"))
            .agg(*metric_columns(actual_col, pred_col)).orderBy("position"))


def top_n_overall_metrics(predictions: DataFrame, *, n: int = 100, actual_col: str = "y_true",
                          pred_col: str = "y_pred", tiebreak: Sequence[str] | None = None) -> DataFrame:
    """MAE/RMSE/R^2 on the n highest actuals overall: one row n, mae, rmse, r2 (none if empty)."""
    require_columns(predictions, [actual_col, pred_col])
    order = [F.col(actual_col).desc()] + [F.col(c).asc() for c in _tiebreak(predictions, tiebreak)]
    top = _defined(predictions, actual_col, pred_col).orderBy(*order).limit(n)
    return top.agg(*metric_columns(actual_col, pred_col)).where(F.col("n") > 0)


def spearman_rank_by_position(predictions: DataFrame, *, position_col: str = "position", actual_col: str = "y_true",
                              pred_col: str = "y_pred") -> DataFrame:
    """Spearman correlation per position: position, n, spearman.

    Average (mid) ranks of both columns within the position, then Pearson on
    the ranks. NaN when n < 2 or either side has zero variance. Both columns
    share one rank table, stacked under a ``which`` key.
    """
    require_columns(predictions, [position_col, actual_col, pred_col])
    base = _defined(predictions, actual_col, pred_col).select(
        F.col(position_col).alias("position"), F.col(actual_col).cast("double").alias("_a"),
        F.col(pred_col).cast("double").alias("_p"))
    stacked = base.select("position", F.expr("stack(2, 'a', _a, 'p', _p) AS (which, value)"))
    ranks = rank_table(stacked, value_col="value", group_cols=["position", "which"], out_col="_r")
    ra = ranks.where(F.col("which") == "a").select("position", F.col("_v").alias("_a"), F.col("_r").alias("_ra"))
    rp = ranks.where(F.col("which") == "p").select("position", F.col("_v").alias("_p"), F.col("_r").alias("_rp"))
    both = base.join(ra, ["position", "_a"], "inner").join(rp, ["position", "_p"], "inner")
    return (both.groupBy("position")
            .agg(F.count(F.lit(1)).alias("n"), pearson_column("_ra", "_rp").alias("spearman"))
            .orderBy("position"))
