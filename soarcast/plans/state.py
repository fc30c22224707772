"""Mart state by year: small tables from which every mart follows without the zone.

Each table has one aggregate per year that merges over years: sums and counts (``calendar_rollup``,
``sky_days``), moments (``cell_moments``, ``month_moments``), distinct keys (``grid_cells``) and
sketches of them (``grid_sketches``). A table notes which version of each zone year it was made
from, so a refresh reads exactly the years that changed since, and drops those that went.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.cells import CELL, position, with_cell_id
from ..functions.moments import corr_of, mean_of, merged, merged_pairs, moments, pair_moments, stddev_of
from ..operators.aggregates import distinct_sketch
from ..operators.filters import flying_hours
from ..sources.publish import NO_YEAR, Published
from . import marts as M

STABILITY_MEASURES = ("wind_speed", "cape", "cloud_base_m")
CORRELATION_MEASURES = ("cape", "cloud_base_m", "blh")
CORRELATED = (("cape", "cloud_base_m"), ("cape", "blh"))


def _flying(obs: DataFrame) -> DataFrame:
    return flying_hours(obs, R.FLYING_SEASON_MONTHS, R.MIDDAY_HOURS)


def cell_moments(obs: DataFrame) -> DataFrame:
    """Per year and cell: its position, hours and moments of Q2's measures in the flying hours."""
    return _flying(with_cell_id(obs)).groupBy("year", CELL).agg(
        position("latitude"), position("longitude"), F.count(F.lit(1)).alias("n_hours"),
        *[moments(c).alias(c) for c in STABILITY_MEASURES])


def month_moments(obs: DataFrame) -> DataFrame:
    """Per year and month: moments of Q5's measures and of its pairs in the flying hours."""
    return _flying(obs).groupBy("year", "month").agg(
        *[moments(c).alias(c) for c in CORRELATION_MEASURES],
        *[pair_moments(x, y).alias(f"{x}_{y}") for x, y in CORRELATED])


def grid_sketches(obs: DataFrame) -> DataFrame:
    """Per year: a mergeable sketch of the distinct cells."""
    return with_cell_id(obs).groupBy("year").agg(distinct_sketch(CELL).alias("cells"))


#: state table -> how it follows from observations; every table has a ``year``
STATE: dict[str, Callable[[DataFrame], DataFrame]] = {
    "calendar_rollup": M.calendar_rollup,
    "cell_moments": cell_moments,
    "month_moments": month_moments,
    "sky_days": M.sky_days,
    "grid_cells": M.grid_keys,
    "grid_sketches": grid_sketches,
}

#: mart -> the state it needs
NEEDS = {
    **{name: ("calendar_rollup",) for name in M.ROLLUP_MARTS},
    **{name: ("calendar_rollup", "grid_cells") for name in M.GRID_COUNT_MARTS},
    "q2_location_stability": ("cell_moments",),
    "q5_cape_cloudbase_correlation": ("month_moments",),
    "q8_afternoon_prediction": ("sky_days",),
}


def merged_conditions(state: DataFrame) -> DataFrame:
    """``marts.cell_conditions`` from ``cell_moments``."""
    return M.conditions_of(
        state.groupBy(CELL), lambda c: stddev_of(merged(c, "year")), lambda c: mean_of(merged(c, "year")), F.sum("n_hours"))


def merged_correlation(state: DataFrame) -> DataFrame:
    """Q5 from ``month_moments``."""
    return M.correlation_mart(
        state.groupBy("month"), lambda x, y: corr_of(merged_pairs(f"{x}_{y}", "year")), lambda c: mean_of(merged(c, "year")))


def state_table(spark: SparkSession, mart_root: str, name: str) -> Published:
    return Published(spark, f"{mart_root.rstrip('/')}/_state/{name}")


def refresh_state(obs: DataFrame, mart_root: str, names: Iterable[str], source: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Bring state tables up to date with ``obs`` and return them.

    ``source`` names the version of each year of the zone that ``obs`` reads (its parts). Years
    whose version a table has not seen are made anew from their rows alone; without ``source``,
    or for a new table, everything is.
    """
    spark, out = obs.sparkSession, {}
    for name in names:
        table = state_table(spark, mart_root, name)
        if not source or not table.exists or not table.notes:
            # few files: a year's rows in one task, a large year split by size
            table.replace_all(STATE[name](obs).hint("rebalance", "year"), ("year",), notes=source)
        else:
            stale = [y for y in source if table.notes.get(y) != source[y]]
            frames = {y: STATE[name](_of_year(obs, y)).drop("year").hint("rebalance") for y in stale}
            gone = {y: None for y in table.parts if y not in source}
            if frames or gone:
                table.replace_years({**frames, **gone}, notes=source)
        out[name] = table.read(STATE[name](obs).schema)
    return out


def _of_year(obs: DataFrame, year: str) -> DataFrame:
    return obs.filter(F.col("year").isNull() if year == NO_YEAR else F.col("year") == int(year))


def build_mart(name: str, state: dict[str, DataFrame], counts: dict[str, int]) -> DataFrame:
    """One mart from state tables; ``counts`` are the grid counts where the mart divides by them."""
    if name == "q2_location_stability":
        return M.rank_cells(merged_conditions(state["cell_moments"]))
    if name == "q5_cape_cloudbase_correlation":
        return merged_correlation(state["month_moments"])
    if name == "q8_afternoon_prediction":
        return M.sky_outlook(state["sky_days"])
    return M.MARTS[name](state["calendar_rollup"], **counts, m=M.Rollup)
