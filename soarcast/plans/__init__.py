"""Composite plans: the curated marts and the batch pipeline."""

from .marts import (
    MARTS,
    blh_through_day,
    cape_cloudbase_correlation,
    category_by_hour,
    category_hours_by_month,
    CALENDAR_MARTS,
    Rollup,
    calendar_rollup,
    cell_conditions,
    cell_day_outlook,
    cell_stability,
    grid_counts,
    climate_trend,
    danger_by_season,
    hourly_conditions,
    joined_cell_days,
    morning_to_afternoon,
    preview,
    rank_cells,
    top_stable_cells,
    top_unstable_cells,
    xc_months,
)
from .batch import build_marts, refresh_zone, run_batch
from .state import STATE, cell_moments, merged_conditions, merged_correlation, month_moments, refresh_state

__all__ = [name for name in dir() if not name.startswith("_")]
