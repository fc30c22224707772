"""Weather inputs derived deterministically from the provided TPC-H-style tables.

The test data has no weather, so grid observations are projected from ``lineitem``
and live events from ``events`` (FIXTURES.md sections 4-5). The projections are plain
column expressions: they scale with the source tables and stay inside the scan's
codegen stage. ``oracle.py`` repeats the same projections in DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import LIVE_SITES
from ..functions.timecols import iso_text
from .events import encode_events


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def grid_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw hourly grid observations (``time`` as timestamp) on a 4x4 cell grid.

    ``obs_id`` (order key * 10 + line number) identifies a row for row-level checks.
    """
    li = table(spark, sf_dir, "lineitem")
    h = (F.col("l_orderkey") + 5 * F.col("l_linenumber")) % 24
    ship_month = F.month(F.col("l_shipdate"))
    t2m = (
        F.lit(278.15)
        + F.lit(2.0) * (6 - F.abs(ship_month - 7))
        + F.lit(0.5) * (12 - F.abs(h - 14))
    )
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("obs_id"),
        F.timestamp_add("HOUR", h, F.col("l_shipdate")).cast("timestamp").alias("time"),
        (F.lit(42.75) + F.lit(0.25) * (F.col("l_suppkey") % 4)).cast("double").alias("latitude"),
        (F.lit(19.5) + F.lit(0.25) * (F.expr("l_suppkey div 4") % 4)).cast("double").alias("longitude"),
        t2m.alias("t2m"),
        (t2m - (F.col("l_discount") * 120.0 - 1.0)).alias("d2m"),
        ((F.col("l_quantity") - 25.0) / 2.0).alias("u10"),
        (F.col("l_tax") * 100.0 - 2.0).alias("v10"),
        (F.col("l_extendedprice") / 50.0).alias("cape"),
        (F.lit(200.0) + (F.col("l_partkey") % 200) * 10.0).alias("blh"),
        (F.lit(95000.0) + F.col("l_suppkey") * 10.0).alias("sp"),
        (((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 101) / 100.0).alias("tcc"),
    )


def site_columns(idx) -> dict:
    """Name, latitude and longitude of live site number ``idx`` (0-based)."""
    pos = (idx + 1).cast("int")
    return {
        "location": F.element_at(F.array(*[F.lit(n) for n, _, _ in LIVE_SITES]), pos),
        "lat": F.element_at(F.array(*[F.lit(float(a)) for _, a, _ in LIVE_SITES]), pos),
        "lon": F.element_at(F.array(*[F.lit(float(o)) for _, _, o in LIVE_SITES]), pos),
    }


def weather_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed live station events (the producer's record layout) from ``events``."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    wind = F.col("value") % 16
    site = site_columns(F.col("user_id") % len(LIVE_SITES))
    return ev.select(
        iso_text(F.col("ts")).alias("timestamp"),
        site["location"].alias("location"),
        site["lat"].alias("lat"),
        site["lon"].alias("lon"),
        (F.lit(10.0) + eid % 20).alias("temp_c"),
        F.lit(None).cast("double").alias("dewpoint_c"),
        F.lit(1013.0).alias("pressure"),
        F.lit(None).cast("double").alias("humidity"),
        wind.alias("wind_speed"),
        F.lit(0.0).alias("wind_dir"),
        (wind * 1.5).alias("wind_gust"),
        ((eid % 11) / 10.0).alias("cloud_cover"),
        F.lit(10000.0).alias("visibility"),
        F.col("event_type").alias("weather_desc"),
        ((eid % 17) * 75.0).alias("cloud_base_m"),
    )


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as topic messages: ``key`` = site, ``value`` = JSON record."""
    return encode_events(weather_events(spark, sf_dir))


def station_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw station-service payloads (JSON text) with ``location`` and ``observed_at``.

    Some payloads omit the wind direction, the gust or the visibility, or carry an
    empty weather list, so every default occurs. Others are no events at all: invalid JSON,
    error bodies, payloads without wind, clouds or temperature, and humidity 0.
    """
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    speed = F.col("value") % 16
    site = site_columns(F.col("user_id") % len(LIVE_SITES))
    payload = F.struct(
        F.struct(site["lat"].alias("lat"), site["lon"].alias("lon")).alias("coord"),
        F.struct(
            F.when(eid % 41 != 0, F.lit(10.0) + eid % 20).alias("temp"),
            (F.lit(1000.0) + eid % 30).alias("pressure"),
            (eid % 100).cast("double").alias("humidity"),
        ).alias("main"),
        F.when(eid % 31 != 0, F.struct(
            speed.alias("speed"),
            F.when(eid % 3 != 0, ((eid * 37) % 360).cast("double")).alias("deg"),
            F.when(eid % 4 != 0, speed * 1.5).alias("gust"),
        )).alias("wind"),
        F.when(eid % 37 != 0, F.struct((eid % 101).cast("double").alias("all"))).alias("clouds"),
        F.when(eid % 5 != 0, F.lit(10000.0) - (eid % 10) * 500.0).alias("visibility"),
        F.when(eid % 7 == 0, F.array().cast("array<struct<description:string>>"))
        .otherwise(F.array(F.struct(F.col("event_type").alias("description"))))
        .alias("weather"),
    )
    return ev.select(
        site["location"].alias("location"),
        F.col("ts").alias("observed_at"),
        F.when(eid % 23 == 0, "{bad").when(eid % 29 == 0, '{"cod":401,"message":"Invalid key"}')
        .otherwise(F.to_json(payload)).alias("payload"),
    )
