"""Nearest grid cell of a site, and baselines by site."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cells import CELL, position, with_cell_id
from ..functions.numeric import stable_round
from .filters import in_months

#: edge in degrees of the tiles on which sites meet cells
TILE = 1.0


def grid_positions(obs: DataFrame) -> DataFrame:
    """``cell_id, latitude, longitude`` of the distinct cells that have a position."""
    placed = obs.filter("latitude IS NOT NULL AND longitude IS NOT NULL")
    if CELL not in obs.columns:  # an id for each position, not for each row
        placed = placed.select("latitude", "longitude").distinct()
    cells = with_cell_id(placed).groupBy(CELL)
    return cells.agg(position("latitude"), position("longitude"))


def nearest_cells(sites: DataFrame, cells: DataFrame, within: float = 0.5, lat: str = "lat", lon: str = "lon", tile: float = TILE) -> DataFrame:
    """``sites`` with the nearest of ``cells``: ``cell_id, cell_latitude, cell_longitude, cell_distance``.

    Distance is in degrees of latitude, a degree of longitude being shorter by the cosine of the
    site's latitude, and the short way round the globe. A site without a cell ``within`` that
    distance (off the grid), or without a position, gets NULLs. Equal distances go to the least id.

    No site is compared with all cells: a site looks into the rings of tiles around it that
    the distance reaches, so a join on tiles brings it together with the cells of a few square
    degrees. Sites at one position are searched once.
    """
    if not 0 < within <= 90 or 360 % tile:
        raise ValueError("within must be in (0, 90] degrees and 360 a multiple of tile")
    around = int(360 / tile)
    where = sites.select(F.col(lat).cast("double").alias("_lat"), F.col(lon).cast("double").alias("_lon"))
    where = where.filter("abs(_lat) <= 90 AND abs(_lon) <= 720").distinct()
    reach = F.least(F.lit(180.0), F.lit(within) / F.greatest(F.cos(F.radians(F.least(F.abs("_lat") + within, F.lit(90.0)))), F.lit(1e-9)))
    rings = where.withColumn("_reach", reach).withColumn(
        "_y", F.explode(F.sequence(F.floor((F.col("_lat") - within) / tile), F.floor((F.col("_lat") + within) / tile))))
    span = F.sequence(F.floor((F.col("_lon") - F.col("_reach")) / tile), F.floor((F.col("_lon") + F.col("_reach")) / tile))
    rings = rings.withColumn("_x", F.explode(F.array_distinct(F.transform(span, lambda x: F.pmod(x, F.lit(around)))))).drop("_reach")
    tiled = cells.select(CELL, F.col("latitude").alias("cell_latitude"), F.col("longitude").alias("cell_longitude")).withColumns({
        "_y": F.floor(F.col("cell_latitude") / tile), "_x": F.pmod(F.floor(F.col("cell_longitude") / tile), F.lit(around))})
    met = rings.join(tiled, ["_y", "_x"])
    apart = F.pmod(F.abs(F.col("_lon") - F.col("cell_longitude")), F.lit(360.0))
    dx = F.least(apart, 360.0 - apart) * F.cos(F.radians("_lat"))
    dy = F.col("_lat") - F.col("cell_latitude")
    met = met.withColumn("_d2", dx * dx + dy * dy).filter(F.col("_d2") <= within * within)
    best = met.groupBy("_lat", "_lon").agg(F.min(F.struct("_d2", CELL, "cell_latitude", "cell_longitude")).alias("_best"))
    found = best.select("_lat", "_lon", f"_best.{CELL}", "_best.cell_latitude", "_best.cell_longitude", F.sqrt("_best._d2").alias("cell_distance"))
    same = (F.col(lat).cast("double") == F.col("_lat")) & (F.col(lon).cast("double") == F.col("_lon"))
    return sites.join(found, same, "left").drop("_lat", "_lon")


def site_baseline(obs: DataFrame, sites: DataFrame, site: str = "location", wind_col: str = "wind_speed", base_col: str = "cloud_base_m") -> DataFrame:
    """Per site and hour of day, the mean conditions of its cell in the season (two digits, as in Q3):
    ``hist_location, hist_hour, hist_wind, hist_cloud_base``.

    ``sites`` has the cell of each site (``nearest_cells``); sites without one have no rows. Only
    rows of those cells are aggregated, by cell, so sites that share a cell share its work. ``sites`` is
    read twice: give it ``session.stored``, and few cells are broadcast to the rows, which then
    are aggregated where they were read; as a plan of unknown size it makes all rows move to their cells.
    """
    cells = sites.filter(F.col(CELL).isNotNull()).select(F.col(site).alias("hist_location"), CELL).distinct()
    rows = in_months(with_cell_id(obs)).join(cells.select(CELL).distinct(), CELL, "left_semi")
    hourly = rows.groupBy(CELL, F.col("hour").alias("hist_hour")).agg(
        stable_round(F.avg(wind_col), 2).alias("hist_wind"), stable_round(F.avg(base_col), 2).alias("hist_cloud_base"))
    return cells.join(hourly, CELL).drop(CELL)
