"""Relational operators: slices, shared aggregates, joins and window operators."""

from .aggregates import approx_distinct_count, distinct_count, distinct_key, distinct_sketch, merged_count, per_unit
from .filters import (
    afternoon_condition,
    diurnal_slice,
    flying_hours,
    hour_range,
    in_box,
    in_months,
    month_range,
    morning_condition,
)
from .joins import CELL_DAY_KEYS, compare_to_baseline, hourly_baseline, join_on_cell_day
from .nearest import grid_positions, nearest_cells, site_baseline
from .windows import centred_mean, change_from_previous, global_rank, running_total, small_rank

__all__ = [name for name in dir() if not name.startswith("_")]
