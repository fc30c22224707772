"""The batch pipeline: raw zone -> transformed zone -> marts -> (optional) database."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.derive import transform
from ..session import utc_session
from ..operators.aggregates import merged_count
from ..sources.grid import TILE_DEGREES, observations, read_raw, replace_zone_years, write_transformed
from ..sources.marts import EXPORTED_MARTS, export_marts, write_mart
from ..sources.publish import Published
from .marts import CALENDAR_MARTS, GRID_COUNT_MARTS, MARTS, counts_of
from .state import NEEDS, build_mart, refresh_state


def refresh_zone(spark: SparkSession, raw_path: str, zone_path: str, years: Iterable[int] | None = None,
                 tile_degrees: float = TILE_DEGREES, rebalance: bool = True) -> None:
    """Transform the raw zone into the transformed zone, all of it or some ``years``.

    A year is what the observation time says, not the raw folder's name, and rows may lie one
    folder off (the last hour of a year, time zones). So for year Y the folders Y-1 to Y+1 are
    read, the rows of Y kept, and the zone's whole folder of Y replaced: no other year is
    touched, and a month that has no rows any more goes. ``rebalance=False`` is for a raw zone
    that ``replace_year`` laid out already (see ``write_transformed``).
    """
    with utc_session(spark):
        if years is None:
            write_transformed(transform(read_raw(spark, raw_path)), zone_path, tile_degrees=tile_degrees, rebalance=rebalance)
            return
        years = sorted({int(y) for y in years})
        near = transform(read_raw(spark, raw_path, sorted({y + k for y in years for k in (-1, 0, 1)})))
        replace_zone_years(near, zone_path, years, tile_degrees=tile_degrees, rebalance=rebalance)


def build_marts(spark: SparkSession, obs: DataFrame, mart_root: str, names: Iterable[str] | None = None,
                source: dict[str, str] | None = None, approximate: bool = False) -> dict[str, str]:
    """Build marts from the zone; returns mart name -> folder.

    Marts follow from state tables below the mart root (``plans.state``), one scan of the zone
    for each table a mart needs. ``source`` tells which version of each year ``obs`` reads
    (``Published.parts`` of the zone); only years that changed since the state was made are
    scanned then. ``approximate`` takes the number of cells that Q1, Q4 and Q7 divide by from
    merged sketches (relative error about one percent) and spares the table of distinct cells.
    """
    names = list(names or MARTS)
    needed = dict.fromkeys(t for n in names for t in NEEDS[n])
    if approximate and needed.pop("grid_cells", 0) is None:
        needed["grid_sketches"] = None
    state = refresh_state(obs, mart_root, needed, source)
    counts = {}
    if "grid_cells" in state:
        counts = counts_of(state["grid_cells"]).first().asDict()
    elif "grid_sketches" in state:
        counts = state["grid_sketches"].agg(merged_count("cells").alias("n_cells"), F.count(F.lit(1)).alias("n_years")).first().asDict()
    written = {}
    for name in names:
        mart = build_mart(name, state, {k: counts[k] for k in GRID_COUNT_MARTS.get(name, ())})
        written[name] = write_mart(mart, mart_root, name, one_file=name in CALENDAR_MARTS)
    return written


def run_batch(
    spark: SparkSession,
    raw_path: str,
    zone_path: str,
    mart_root: str,
    years: Iterable[int] | None = None,
    marts: Iterable[str] | None = None,
    export: Mapping | None = None,
    tile_degrees: float = TILE_DEGREES,
    rebalance: bool = True,
    approximate: bool = False,
) -> dict[str, str]:
    """Transform, then build every mart from the written zone, then export.

    ``years`` re-processes only those years of the zone (``refresh_zone``); the marts follow from
    state by year, and of the zone only years are read that changed since that state was made.
    Rows without a time belong to no year: a run of some years leaves them as they are, a full
    run writes them anew. ``approximate`` is passed to ``build_marts``. ``export`` = ``{"url": ..., "properties": {...}}``
    copies the exported marts to a database. Returns mart name -> folder.
    """
    refresh_zone(spark, raw_path, zone_path, years, tile_degrees, rebalance)
    with utc_session(spark):
        zone = Published(spark, zone_path)
        written = build_marts(spark, observations(zone), mart_root, marts, zone.parts, approximate)
        if export:
            mapping = {k: v for k, v in EXPORTED_MARTS.items() if k in written}
            export_marts(spark, mart_root, export["url"], export.get("properties", {}), mapping)
    return written
