"""Date expressions. ``now`` is always an argument, never the clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: input formats and constants --------------------------------------
DATE_FORMAT = "dd-MM-yyyy"
DATETIME_FORMAT = "dd-MM-yyyy HH:mm:ss"
SLASH_DATETIME_FORMAT = "dd/MM/yyyy HH:mm"
DAYS_PER_YEAR = 365.25
# --------------------------------------------------------------------------------------


def parse_date(c: Column, fmt: str = DATE_FORMAT) -> Column:
    return F.try_to_date(c, fmt)


def parse_datetime(c: Column, fmt: str = DATETIME_FORMAT) -> Column:
    return F.try_to_timestamp(c, F.lit(fmt))


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole 24-hour days, truncated toward zero; null if either side is null."""
    return F.timestamp_diff("DAY", earlier, later)


def days_or_zero(later: Column, earlier: Column, absolute: bool = False) -> Column:
    """Day difference; a missing or negative difference gives 0."""
    days = whole_days(later, earlier)
    return F.greatest(F.coalesce(F.abs(days) if absolute else days, F.lit(-1)), F.lit(0)).cast("bigint")


def years_or_zero(later: Column, earlier: Column) -> Column:
    years = whole_days(later, earlier) / F.lit(DAYS_PER_YEAR)
    return F.greatest(F.coalesce(years, F.lit(-1.0)), F.lit(0.0))


def calendar_days(later: Column, earlier: Column) -> Column:
    """Difference of calendar dates, -1 when missing, negative values kept."""
    return F.coalesce(F.datediff(later, earlier), F.lit(-1))


def flag_or_minus_one(condition: Column, *required: Column) -> Column:
    """0/1 flag, -1 when a required input is null."""
    present = required[0].isNotNull()
    for c in required[1:]:
        present = present & c.isNotNull()
    return F.when(present, condition.cast("tinyint")).otherwise(F.lit(-1).cast("tinyint"))
