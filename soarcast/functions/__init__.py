"""Column-level functions: derived measures, labels, rounding and ratios."""

from .cells import add_cell_id, box_ranges, cell_id, with_cell_id
from .derive import (
    cloud_base,
    danger_flag,
    flying_category,
    season,
    sky_bucket,
    thermal_strength,
    time_of_day,
    transform,
    wind_direction,
    wind_speed,
    with_calendar,
    with_celsius,
    with_cloud_base,
    with_danger_flag,
    with_flying_category,
    with_season,
    with_thermal_strength,
    with_time_of_day,
    with_wind,
    with_xc_flag,
    xc_flag,
)
from .live import (
    alert_level,
    cloud_alert,
    conditions_vs_avg,
    flying_score,
    wind_alert,
    with_alert,
    with_flying_score,
)
from .numeric import count_where, dewpoint_magnus, percent_of_rows, percent_where, ratio, safe_corr, stable_round
from .timecols import normalize_time

__all__ = [name for name in dir() if not name.startswith("_")]
