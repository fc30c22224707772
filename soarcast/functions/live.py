"""Column expressions of the live station events: score, alerts, baseline labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rules as R
from .derive import _chain
from .numeric import _col


def _known(expr: Column, inputs: list[Column], strict: bool) -> Column:
    """``expr``, or NULL where an input is NULL if ``strict``."""
    return F.when(reduce(lambda a, b: a & b, [c.isNotNull() for c in inputs]), expr) if strict else expr


def flying_score(strict_nulls: bool = False) -> Column:
    """0..10 suitability. High wind or low base gives 0; otherwise a capped blend.

    ``least`` skips NULLs, so an event with a missing measure scores the cap;
    ``strict_nulls=True`` gives NULL instead.
    """
    wind, base = F.col("wind_speed"), F.col("cloud_base_m")
    blend = (
        base / R.SCORE_CLOUD_BASE_DIVISOR * R.SCORE_CLOUD_BASE_WEIGHT
        + (F.lit(R.SCORE_WIND_REFERENCE) - wind) * R.SCORE_WIND_WEIGHT
        + F.when(F.col("cloud_cover") < R.SCORE_CLEAR_SKY_BELOW, F.lit(R.SCORE_CLEAR_SKY_BONUS)).otherwise(
            F.lit(0)
        )
    )
    score = (
        F.when(wind > R.SCORE_ZERO_WIND_ABOVE, 0)
        .when(base < R.SCORE_ZERO_CLOUD_BASE_BELOW, 0)
        .otherwise(F.least(F.lit(R.SCORE_MAX), blend))
    )
    return _known(score, [wind, base, F.col("cloud_cover")], strict_nulls)


def with_flying_score(df: DataFrame, strict_nulls: bool = False) -> DataFrame:
    """``flying_score`` (double) and ``flyable`` (YES/NO; NULL without a score if strict)."""
    df = df.withColumn("flying_score", flying_score(strict_nulls))
    flyable = F.when(F.col("flying_score") >= R.FLYABLE_SCORE_MIN, "YES").otherwise("NO")
    return df.withColumn("flyable", _known(flyable, [F.col("flying_score")], strict_nulls))


def alert_level(strict_nulls: bool = False) -> Column:
    wind, base = F.col("wind_speed"), F.col("cloud_base_m")
    level = _chain(
        [
            (wind > R.ALERT_HIGH_WIND_ABOVE, "DANGER_HIGH_WIND"),
            (F.col("wind_gust") > R.ALERT_GUST_ABOVE, "DANGER_GUSTS"),
            (base < R.ALERT_LOW_CLOUD_BELOW, "DANGER_LOW_CLOUD"),
            ((wind > R.ALERT_COMBINED_WIND_ABOVE) & (base < R.ALERT_COMBINED_CLOUD_BELOW), "WARNING_COMBINED"),
        ],
        R.ALERT_SAFE,
    )
    return _known(level, [wind, F.col("wind_gust"), base], strict_nulls)


def with_alert(df: DataFrame, strict_nulls: bool = False) -> DataFrame:
    return df.withColumn("alert", alert_level(strict_nulls))


def wind_alert(max_wind: Column | str = "max_wind", strict_nulls: bool = False) -> Column:
    m = _col(max_wind)
    return _known(_chain([(m > lim, label) for label, lim in R.WIND_ALERT_BANDS], R.WINDOW_ALERT_OK), [m], strict_nulls)


def cloud_alert(min_cloud_base: Column | str = "min_cloud_base", strict_nulls: bool = False) -> Column:
    m = _col(min_cloud_base)
    return _known(_chain([(m < lim, label) for label, lim in R.CLOUD_ALERT_BANDS], R.WINDOW_ALERT_OK), [m], strict_nulls)


def conditions_vs_avg(wind_diff: Column | str = "wind_vs_historical", strict_nulls: bool = False) -> Column:
    d = _col(wind_diff)
    compared = _chain(
        [(d > R.BASELINE_WIND_MARGIN, R.VS_AVG_WORSE), (d < -R.BASELINE_WIND_MARGIN, R.VS_AVG_BETTER)],
        R.VS_AVG_SAME,
    )
    return _known(compared, [d], strict_nulls)
