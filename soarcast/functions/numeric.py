"""Numeric helpers shared by all marts: deterministic rounding, ratios, guarded corr."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from .rules import MAGNUS_A, MAGNUS_B

# Precision of the intermediate decimal. Nine fractional digits absorb the last-ulp
# noise that different summation orders (partitionings) leave in a double aggregate,
# so a mean that is mathematically 1.005 rounds the same on every cluster layout.
_ROUND_DECIMAL = DecimalType(28, 9)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stable_round(c: Column | str, scale: int) -> Column:
    """HALF_UP rounding of a double through ``decimal(28,9)``; result is double.

    Values that the decimal cannot hold (1e19 and beyond) are rounded as plain doubles;
    NaN and +-inf stay what they are.
    """
    value = _col(c)
    exact = F.round(value.try_cast(_ROUND_DECIMAL), scale).cast("double")
    return F.coalesce(exact, F.round(value.cast("double"), scale))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """``numerator / denominator`` as double; NULL instead of an ANSI error on 0."""
    return F.try_divide(_col(numerator), _col(denominator))


def count_where(cond: Column) -> Column:
    """Number of rows where ``cond`` is TRUE (NULL counts as false); bigint."""
    return F.count_if(cond)


def percent_of_rows(count: Column) -> Column:
    """``count * 100.0 / count(*)`` inside an aggregation, as double."""
    return ratio(count * F.lit(100.0), F.count(F.lit(1)))


def percent_where(cond: Column) -> Column:
    """``100 * (rows where cond) / (all rows)`` as double."""
    return percent_of_rows(F.count_if(cond))


def safe_corr(a: Column | str, b: Column | str) -> Column:
    """Pearson correlation that is NULL (not an ANSI error) for a constant input.

    Equals ``corr(a, b)``: pairs with a NULL side are ignored and each variance is
    taken over the remaining pairs. Fewer than two pairs give NULL, like ``corr``.
    """
    a, b = _col(a), _col(b)
    a_paired = F.when(b.isNotNull(), a)
    b_paired = F.when(a.isNotNull(), b)
    spread = F.sqrt(F.var_pop(a_paired) * F.var_pop(b_paired))
    return F.try_divide(F.covar_pop(a, b), F.when(spread > 0, spread))


def dewpoint_magnus(temp_c: Column | str, humidity_pct: Column | str) -> Column:
    """Magnus dew point (degC) from temperature and relative humidity, 2 decimals.

    Humidity <= 0 gives NULL (the logarithm is undefined there).
    """
    t, rh = _col(temp_c), _col(humidity_pct)
    alpha = (F.lit(MAGNUS_A) * t) / (F.lit(MAGNUS_B) + t) + F.log(rh / 100.0)
    return stable_round((F.lit(MAGNUS_B) * alpha) / (F.lit(MAGNUS_A) - alpha), 2)
