"""Joins: cell-day pairing (D1) and the hourly baseline lookup (D2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cells import CELL, add_cell_id

CELL_DAY_KEYS = ("year", "month", "day", CELL)


def join_on_cell_day(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Equi-join two per-(cell, day) aggregates on ``year, month, day, cell_id``.

    The id stands for the position (``functions.cells``), so the position's own columns are
    taken from the left side only. A side without ids gets them from its position; rows without a
    position match nothing, as in a join on coordinates.

    When both sides are aggregates grouped by these keys they are already hash
    partitioned on them, so the join adds no exchange. For two aggregates of the
    *same* source prefer one conditional aggregation (see ``plans.marts.morning_to_afternoon``),
    which shuffles the source once instead of twice.
    """
    joined = _with_key(left).join(_with_key(right).drop("latitude", "longitude"), list(CELL_DAY_KEYS), how)
    return joined if CELL in left.columns or CELL in right.columns else joined.drop(CELL)


def _with_key(df: DataFrame) -> DataFrame:
    if CELL in df.columns:
        return df
    placed = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    return add_cell_id(df).withColumn(CELL, F.when(placed, F.col(CELL)))


def hourly_baseline(mart: DataFrame, wind_col: str = "avg_wind", base_col: str = "avg_cloud_base") -> DataFrame:
    """One row per hour of day (0-23) from an hourly mart: ``hist_hour, hist_wind, hist_cloud_base``.

    The result has at most 24 rows whatever the mart holds: hours outside 0-23
    cannot match an event hour and are dropped, and the grouping keeps one row per
    hour (for a mart that is already one row per hour, the mean is that row's value).
    That bound is what makes broadcasting it safe.
    """
    return (
        mart.filter(F.col("hour").between(0, 23))
        .groupBy(F.col("hour").alias("hist_hour"))
        .agg(F.avg(wind_col).alias("hist_wind"), F.avg(base_col).alias("hist_cloud_base"))
    )


def compare_to_baseline(events: DataFrame, baseline: DataFrame, time_col: str = "event_time", site_col: str = "location") -> DataFrame:
    """Left-join each event to the baseline row of its hour of day.

    ``baseline`` is the output of ``hourly_baseline`` (<= 24 rows), broadcast to every
    task, so the event stream is never shuffled; works for batch and streaming events. A baseline
    by site (``nearest.site_baseline``, with ``hist_location``) is joined on site and hour; its size
    follows the number of sites, so how it is joined is left to the optimizer, which broadcasts a
    small one that is ``session.stored``.
    """
    by_site = "hist_location" in baseline.columns
    columns = [*events.columns, "hour", *[c for c in baseline.columns if c not in ("hist_hour", "hist_location")]]
    right = baseline.withColumnRenamed("hist_hour", "hour")
    keys = ["hour"]
    if by_site:
        right, keys = right.withColumnRenamed("hist_location", site_col), ["hour", site_col]
    return events.withColumn("hour", F.hour(time_col)).join(right if by_site else F.broadcast(right), keys, "left").select(*columns)
