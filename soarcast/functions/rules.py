"""Threshold tables for every classification rule.

The rules are data; ``derive.py`` and ``live.py`` turn them into ``F.when``
chains, so each boundary is written exactly once.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class CategoryRule:
    """One flight-suitability class. Bounds marked ``incl`` are inclusive."""

    name: str
    wind_min: float  # incl
    wind_max: float  # incl
    cape_min: float
    cape_max: float | None  # incl; None = no upper bound
    cape_min_incl: bool  # False: cape > cape_min, True: cape >= cape_min
    cloud_base_above: float  # strict
    tcc_below: float  # strict


# --- Fixed values: these must equal the reference's thresholds. -----------------

KELVIN_OFFSET = 273.15

# First matching rule wins; otherwise FLYING_FALLBACK.
FLYING_RULES = (
    CategoryRule("expert", 2, 12, 300, None, False, 800, 0.8),
    CategoryRule("beginner", 1, 8, 100, 800, True, 500, 0.6),
    CategoryRule("student", 1, 5, 50, 300, True, 300, 0.5),
)
FLYING_FALLBACK = "not_flyable"

# (label, cape strictly below); last label has no upper bound.
THERMAL_BANDS = (("none", 100), ("weak", 500), ("moderate", 1000))
THERMAL_TOP = "strong"

# (label, first hour incl, last hour excl)
TIME_OF_DAY_BANDS = (
    ("morning", 6, 10),
    ("midday", 10, 14),
    ("afternoon", 14, 18),
    ("evening", 18, 21),
)
TIME_OF_DAY_OTHER = "non_flying"

SEASON_MONTHS = (
    ("winter", (12, 1, 2)),
    ("spring", (3, 4, 5)),
    ("summer", (6, 7, 8)),
)
SEASON_OTHER = "autumn"

# Dangerous hour: any of wind > 12, cape > 2000, cloud base < 100, tcc > 0.9.
DANGER_WIND_ABOVE = 12
DANGER_CAPE_ABOVE = 2000
DANGER_CLOUD_BASE_BELOW = 100
DANGER_TCC_ABOVE = 0.9

# Cross-country hour: all of cape > 500, blh > 1000, wind in [2, 10],
# cloud base > 1000, tcc < 0.7, hour in [10, 16].
XC_CAPE_ABOVE = 500
XC_BLH_ABOVE = 1000
XC_WIND_RANGE = (2, 10)
XC_CLOUD_BASE_ABOVE = 1000
XC_TCC_BELOW = 0.7
XC_HOUR_RANGE = (10, 16)

# Morning sky from mean cloud cover: (label, tcc strictly below).
SKY_BANDS = (("clear", 0.2), ("partly_cloudy", 0.5), ("mostly_cloudy", 0.8))
SKY_TOP = "overcast"

# Live flying score.
SCORE_MAX = 10.0
SCORE_ZERO_WIND_ABOVE = 12
SCORE_ZERO_CLOUD_BASE_BELOW = 300
SCORE_CLOUD_BASE_DIVISOR = 300
SCORE_CLOUD_BASE_WEIGHT = 2
SCORE_WIND_REFERENCE = 10
SCORE_WIND_WEIGHT = 0.5
SCORE_CLEAR_SKY_BELOW = 0.5
SCORE_CLEAR_SKY_BONUS = 2
FLYABLE_SCORE_MIN = 5

# Point alerts, first match wins.
ALERT_HIGH_WIND_ABOVE = 12
ALERT_GUST_ABOVE = 15
ALERT_LOW_CLOUD_BELOW = 200
ALERT_COMBINED_WIND_ABOVE = 8
ALERT_COMBINED_CLOUD_BELOW = 500
ALERT_SAFE = "SAFE"

# Window alerts.
WIND_ALERT_BANDS = (("HIGH_WIND", 10), ("MODERATE_WIND", 7))  # max wind strictly above
CLOUD_ALERT_BANDS = (("LOW_CLOUD", 300), ("MODERATE_CLOUD", 600))  # min base strictly below
WINDOW_ALERT_OK = "OK"

# Comparison with the hourly baseline.
BASELINE_WIND_MARGIN = 3
VS_AVG_WORSE = "WORSE_THAN_AVG"
VS_AVG_BETTER = "BETTER_THAN_AVG"
VS_AVG_SAME = "AVERAGE"

# Magnus dew-point coefficients.
MAGNUS_A = 17.27
MAGNUS_B = 237.7

# Live sites: (name, latitude, longitude).
LIVE_SITES = (
    ("Vrsac", 45.1167, 21.3000),
    ("Fruska_Gora", 45.1333, 19.7000),
    ("Rtanj", 43.7667, 21.9000),
    ("Zlatibor", 43.7333, 19.7167),
    ("Kopaonik", 43.2833, 20.8000),
)

# Windows and watermarks of the live views.
TUMBLING_WINDOW = "5 minutes"
TUMBLING_WATERMARK = "5 minutes"
SLIDING_WINDOW = "10 minutes"
SLIDING_SLIDE = "5 minutes"
SLIDING_WATERMARK = "10 minutes"

# Analysis slices (inclusive ranges).
FLYING_SEASON_MONTHS = (4, 9)
MIDDAY_HOURS = (8, 18)
DAYLIGHT_HOURS = (6, 21)
SUMMER_MONTHS = (5, 8)
MORNING_HOURS = (6, 9)
MORNING_MIN_TEMP_C = 10
AFTERNOON_HOURS = (12, 16)

# Stability score weights: wind sd, cape sd, cloud-base sd.
STABILITY_WEIGHTS = (0.4, 0.001, 0.01)
