"""Column builders shared by the operators.

Every decision about an absent column is taken from ``df.columns`` while the
plan is built, so none of these helpers runs a Spark job. Four policies for
an absent optional column exist on purpose (each operator keeps its own):

* ``num_or_zero``      -> literal 0.0 (weekly scoring, features)
* ``with_zero_columns``-> the column is materialized as 0.0 and stays
* ``num_or_null``      -> typed null (age)
* the aggregate leaves the output column out (season totals)
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, cols: Iterable[str], message: str = "Missing required columns") -> None:
    """Raise ``ValueError`` naming every column of ``cols`` absent from ``df``."""
    present = set(df.columns)
    missing = [c for c in cols if c not in present]
    if missing:
        raise ValueError(f"{message}: {missing}")


def num_or_zero(df: DataFrame, name: str) -> Column:
    """Absent -> 0.0; present -> cast to double with nulls as 0.0."""
    if name not in df.columns:
        return F.lit(0.0)
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))


def num_or_null(df: DataFrame, name: str) -> Column:
    """Absent -> typed null; present -> cast to double, nulls kept."""
    if name not in df.columns:
        return F.lit(None).cast("double")
    return F.col(name).cast("double")


def zero_if_null(name: str) -> Column:
    """Null -> 0 without a cast (the column keeps its own type)."""
    return F.coalesce(F.col(name), F.lit(0))


def with_zero_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Add each absent column of ``names`` as a 0.0 double column."""
    absent = {n: F.lit(0.0) for n in dict.fromkeys(names) if n not in df.columns}
    return df.withColumns(absent) if absent else df


def drop_nulls(df: DataFrame, subset: Iterable[str]) -> DataFrame:
    """Keep rows with no null in ``subset``. NaN is kept, unlike ``na.drop``."""
    cols = list(subset)
    require_columns(df, cols)
    if not cols:
        return df
    cond = None
    for c in cols:
        term = F.col(c).isNotNull()
        cond = term if cond is None else cond & term
    return df.where(cond)
