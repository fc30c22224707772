"""Derived columns of the hourly grid observation (the transform step).

Each ``with_*`` function is a lazy ``DataFrame -> DataFrame`` projection; ``transform``
chains them. Catalyst collapses the chain into one Project inside the scan's
whole-stage-codegen span, so the transform never shuffles.

NULL semantics follow ``CASE WHEN``: a NULL input fails every test and falls through
to the last label (e.g. NULL cape -> ``"strong"``). ``strict_nulls=True`` instead
yields NULL whenever an input of the rule is NULL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from . import rules as R
from .numeric import _col
from .timecols import normalize_time

RAW_CONSUMED = ("t2m", "d2m", "u10", "v10")
UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


def _chain(branches: list[tuple[Column, str]], otherwise: str) -> Column:
    first_cond, first_label = branches[0]
    expr = F.when(first_cond, first_label)
    for cond, label in branches[1:]:
        expr = expr.when(cond, label)
    return expr.otherwise(otherwise)


def _strict(expr: Column, inputs: list[Column], strict: bool) -> Column:
    if not strict:
        return expr
    any_null = reduce(lambda a, b: a | b, [c.isNull() for c in inputs])
    return F.when(any_null, F.lit(None).cast("string")).otherwise(expr)


def as_doubles(df: DataFrame) -> DataFrame:
    """Every float column as double: grids are often stored in single precision, and all
    derivations are defined on doubles."""
    singles = [f.name for f in df.schema.fields if isinstance(f.dataType, FloatType)]
    return df.withColumns({c: F.col(c).cast("double") for c in singles}) if singles else df


def with_calendar(df: DataFrame, time_col: str = "time") -> DataFrame:
    """``year, month, day, hour`` (int) of the observation time in UTC.

    Calendar parts follow the session's time zone, so a session in another zone is refused.
    """
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        raise ValueError(f"calendar columns are defined in UTC, but the session's time zone is {zone} (see session.utc_session)")
    df = normalize_time(df, time_col)
    t = F.col(time_col)
    return df.withColumns(
        {"year": F.year(t), "month": F.month(t), "day": F.dayofmonth(t), "hour": F.hour(t)}
    )


def with_celsius(df: DataFrame) -> DataFrame:
    """``temp_c``, ``dewpoint_c`` from Kelvin ``t2m``, ``d2m``."""
    return df.withColumns(
        {
            "temp_c": F.col("t2m") - R.KELVIN_OFFSET,
            "dewpoint_c": F.col("d2m") - R.KELVIN_OFFSET,
        }
    )


def wind_speed(u: Column | str = "u10", v: Column | str = "v10") -> Column:
    u, v = _col(u).cast("double"), _col(v).cast("double")
    return F.sqrt(u * u + v * v)


def wind_direction(u: Column | str = "u10", v: Column | str = "v10") -> Column:
    """Degrees in [0, 360): ``(degrees(atan2(u, v)) + 180) % 360``; calm gives 180."""
    return (F.degrees(F.atan2(_col(u), _col(v))) + 180) % 360


def with_wind(df: DataFrame) -> DataFrame:
    return df.withColumns({"wind_speed": wind_speed(), "wind_dir": wind_direction()})


def cloud_base(temp_c: Column | str = "temp_c", dewpoint_c: Column | str = "dewpoint_c") -> Column:
    """Convective cloud base (m) from the temperature/dew-point spread."""
    return (_col(temp_c) - _col(dewpoint_c)) / 8 * 1000


def with_cloud_base(df: DataFrame) -> DataFrame:
    """``cloud_base_m`` and ``fog_condition`` (base below ground); needs ``with_celsius``."""
    df = df.withColumn("cloud_base_m", cloud_base())
    return df.withColumn("fog_condition", F.col("cloud_base_m") < 0)


def _rule_test(rule: R.CategoryRule) -> Column:
    wind, cape = F.col("wind_speed"), F.col("cape")
    if rule.cape_max is None:
        cape_ok = cape >= rule.cape_min if rule.cape_min_incl else cape > rule.cape_min
    elif rule.cape_min_incl:
        cape_ok = cape.between(rule.cape_min, rule.cape_max)
    else:
        cape_ok = (cape > rule.cape_min) & (cape <= rule.cape_max)
    return (
        wind.between(rule.wind_min, rule.wind_max)
        & cape_ok
        & (F.col("cloud_base_m") > rule.cloud_base_above)
        & (F.col("tcc") < rule.tcc_below)
    )


def flying_category(rules=R.FLYING_RULES, strict_nulls: bool = False) -> Column:
    expr = _chain([(_rule_test(r), r.name) for r in rules], R.FLYING_FALLBACK)
    inputs = [F.col(c) for c in ("wind_speed", "cape", "cloud_base_m", "tcc")]
    return _strict(expr, inputs, strict_nulls)


def with_flying_category(df: DataFrame, rules=R.FLYING_RULES, strict_nulls: bool = False) -> DataFrame:
    return df.withColumn("flying_category", flying_category(rules, strict_nulls))


def thermal_strength(cape: Column | str = "cape", strict_nulls: bool = False) -> Column:
    cape = _col(cape)
    expr = _chain([(cape < hi, label) for label, hi in R.THERMAL_BANDS], R.THERMAL_TOP)
    return _strict(expr, [cape], strict_nulls)


def with_thermal_strength(df: DataFrame, strict_nulls: bool = False) -> DataFrame:
    return df.withColumn("thermal_strength", thermal_strength("cape", strict_nulls))


def time_of_day(hour: Column | str = "hour", strict_nulls: bool = False) -> Column:
    h = _col(hour)
    branches = [((h >= lo) & (h < hi), label) for label, lo, hi in R.TIME_OF_DAY_BANDS]
    return _strict(_chain(branches, R.TIME_OF_DAY_OTHER), [h], strict_nulls)


def with_time_of_day(df: DataFrame, strict_nulls: bool = False) -> DataFrame:
    return df.withColumn("time_of_day", time_of_day("hour", strict_nulls))


def season(month: Column | str = "month", strict_nulls: bool = False) -> Column:
    m = _col(month)
    branches = [(m.isin(*months), label) for label, months in R.SEASON_MONTHS]
    return _strict(_chain(branches, R.SEASON_OTHER), [m], strict_nulls)


def with_season(df: DataFrame, strict_nulls: bool = False) -> DataFrame:
    return df.withColumn("season", season("month", strict_nulls))


def transform(raw: DataFrame, strict_nulls: bool = False) -> DataFrame:
    """Raw grid observations -> analysis-ready observations (B1-B11).

    Adds calendar parts, Celsius temperatures, wind speed/direction, cloud base, fog,
    flight category, thermal strength, time of day and season, then drops the raw
    Kelvin and wind-component columns. ``time`` is normalised to a timestamp.
    """
    df = with_calendar(as_doubles(raw))
    df = with_celsius(df)
    df = with_wind(df)
    df = with_cloud_base(df)
    df = df.withColumns(
        {
            "flying_category": flying_category(strict_nulls=strict_nulls),
            "thermal_strength": thermal_strength("cape", strict_nulls),
            "time_of_day": time_of_day("hour", strict_nulls),
            "season": season("month", strict_nulls),
        }
    )
    return df.drop(*RAW_CONSUMED)


def danger_flag() -> Column:
    """1 if any hazard threshold is crossed, else 0 (int)."""
    cond = (
        (F.col("wind_speed") > R.DANGER_WIND_ABOVE)
        | (F.col("cape") > R.DANGER_CAPE_ABOVE)
        | (F.col("cloud_base_m") < R.DANGER_CLOUD_BASE_BELOW)
        | (F.col("tcc") > R.DANGER_TCC_ABOVE)
    )
    return F.when(cond, 1).otherwise(0)


def with_danger_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("dangerous", danger_flag())


def xc_flag() -> Column:
    """1 if the hour suits cross-country flying, else 0 (int)."""
    lo_w, hi_w = R.XC_WIND_RANGE
    lo_h, hi_h = R.XC_HOUR_RANGE
    cond = (
        (F.col("cape") > R.XC_CAPE_ABOVE)
        & (F.col("blh") > R.XC_BLH_ABOVE)
        & F.col("wind_speed").between(lo_w, hi_w)
        & (F.col("cloud_base_m") > R.XC_CLOUD_BASE_ABOVE)
        & (F.col("tcc") < R.XC_TCC_BELOW)
        & F.col("hour").between(lo_h, hi_h)
    )
    return F.when(cond, 1).otherwise(0)


def with_xc_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("xc_suitable", xc_flag())


def sky_bucket(tcc: Column | str) -> Column:
    """Sky label from a (mean) total cloud cover in 0..1."""
    c = _col(tcc)
    return _chain([(c < hi, label) for label, hi in R.SKY_BANDS], R.SKY_TOP)
