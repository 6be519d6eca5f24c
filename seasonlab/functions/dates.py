"""Date helpers for the season-age features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Age is taken on September 1 of the season year and is the
# floor of the day difference divided by 365.25 (not calendar age).
SEASON_START_MONTH = 9
SEASON_START_DAY = 1
DAYS_PER_YEAR = 365.25
BIRTH_DATE_FORMAT = "yyyy-MM-dd"


def parse_date_lenient(col: Column | str, fmt: str = BIRTH_DATE_FORMAT) -> Column:
    """``yyyy-MM-dd`` text to a date; unparseable text gives null (no error)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_date(c, fmt)


def season_reference_date(season: Column | str) -> Column:
    """September 1 of the season year."""
    s = F.col(season) if isinstance(season, str) else season
    return F.make_date(s, F.lit(SEASON_START_MONTH), F.lit(SEASON_START_DAY))


def age_on_reference_date(season: Column | str, birth_date: Column) -> Column:
    """floor(days(birth -> Sept 1 of season) / 365.25) as a double."""
    days = F.datediff(season_reference_date(season), birth_date)
    return F.floor(days / F.lit(DAYS_PER_YEAR)).cast("double")
