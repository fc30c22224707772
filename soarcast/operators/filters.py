"""Row slices used by the marts. Month is the zone's partition column, so a month
range prunes whole directories; hour ranges are pushed into the Parquet reader."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.cells import CELL, box_ranges


def month_range(lo: int, hi: int) -> Column:
    return F.col("month").between(lo, hi)


def hour_range(lo: int, hi: int) -> Column:
    return F.col("hour").between(lo, hi)


def in_months(df: DataFrame, lo: int = R.FLYING_SEASON_MONTHS[0], hi: int = R.FLYING_SEASON_MONTHS[1]) -> DataFrame:
    """Months ``lo..hi`` inclusive (default: the April-September flying season)."""
    return df.filter(month_range(lo, hi))


def flying_hours(
    df: DataFrame,
    months: tuple[int, int] = R.FLYING_SEASON_MONTHS,
    hours: tuple[int, int] = R.MIDDAY_HOURS,
    flyable_only: bool = False,
) -> DataFrame:
    """Season months and an hour range, optionally only flyable hours.

    ``flyable_only`` drops ``not_flyable`` rows and rows whose category is NULL.
    """
    cond = month_range(*months) & hour_range(*hours)
    if flyable_only:
        cond = cond & (F.col("flying_category") != R.FLYING_FALLBACK)
    return df.filter(cond)


def morning_condition() -> Column:
    """Warm morning hour: 06-09 with temperature above 10 degC."""
    return hour_range(*R.MORNING_HOURS) & (F.col("temp_c") > R.MORNING_MIN_TEMP_C)


def afternoon_condition() -> Column:
    return hour_range(*R.AFTERNOON_HOURS)


def diurnal_slice(df: DataFrame) -> DataFrame:
    """Summer months, restricted to warm morning hours and afternoon hours."""
    return df.filter(month_range(*R.SUMMER_MONTHS) & (morning_condition() | afternoon_condition()))


def in_box(df: DataFrame, south: float, west: float, north: float, east: float, ranges: int = 32) -> DataFrame:
    """Rows whose position lies in a box, its edges included.

    Of rows that carry their cell id, at most ``ranges`` ranges of ids are read, so that files and
    row groups of the zone, which are sorted by id, are skipped; the coordinates decide.
    """
    exact = F.col("latitude").between(south, north) & F.col("longitude").between(west, east)
    if CELL not in df.columns:
        return df.filter(exact)
    near = reduce(lambda a, b: a | b, [F.col(CELL).between(lo, hi) for lo, hi in box_ranges(south, west, north, east, ranges)])
    return df.filter(near).filter(exact)
