"""Column-level building blocks (JVM-side expressions only, no UDFs)."""

from seasonlab.functions.columns import (
    drop_nulls,
    num_or_null,
    num_or_zero,
    require_columns,
    with_zero_columns,
    zero_if_null,
)
from seasonlab.functions.dates import age_on_reference_date, parse_date_lenient, season_reference_date
from seasonlab.functions.rates import per_game, safe_divisor, square

__all__ = [
    "age_on_reference_date",
    "drop_nulls",
    "num_or_null",
    "num_or_zero",
    "parse_date_lenient",
    "per_game",
    "require_columns",
    "safe_divisor",
    "season_reference_date",
    "square",
    "with_zero_columns",
    "zero_if_null",
]
