"""

Every query reads the given parquet tables: grid observations are projected from
``lineitem`` and station events from ``events`` (``soarcast.sources.fixtures``), then
run through the library exactly as production data would be. ``oracle_sql`` holds an
independent DuckDB statement per key (``soarcast.oracle``).
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

# importable from any working directory
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from soarcast import oracle
from soarcast.functions import add_cell_id, danger_flag, dewpoint_magnus, normalize_time, safe_corr, stable_round, transform, xc_flag
from soarcast.functions.live import alert_level
from soarcast.operators import (
    distinct_count,
    distinct_sketch,
    diurnal_slice,
    flying_hours,
    global_rank,
    grid_positions,
    hourly_baseline,
    in_box,
    in_months,
    merged_count,
    nearest_cells,
    site_baseline,
)
from soarcast.plans import cell_moments, marts, merged_conditions, merged_correlation, month_moments
from soarcast.session import ensure_utc, scratch_folder, session_settings, stored
from soarcast.sources import fixtures, read_raw, read_transformed, write_transformed
from soarcast.sources.events import parse_events, parse_payload
from soarcast.streaming import views

try:
    # the training-data subpackage and its pipeline can be taken out as a whole
    import corpus_pipeline
    from soarcast.llm import registry as llm
except ModuleNotFoundError as error:
    if error.name not in ("corpus_pipeline", "soarcast.llm"):
        raise
    corpus_pipeline = llm = None

SMOKE_DIR = "/root/testdata/sf0.001"


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return transform(fixtures.grid_raw(spark, sf_dir))


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return views.score_events(parse_events(fixtures.event_messages(spark, sf_dir)))


def _mart(build) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(observations(spark, sf_dir))


def _live(build) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(scored_events(spark, sf_dir))


def _vs_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    baseline = hourly_baseline(marts.hourly_conditions(observations(spark, sf_dir)))
    return views.versus_baseline(scored_events(spark, sf_dir), baseline)


def _obs_cols(*cols) -> Callable[[SparkSession, str], DataFrame]:
    """Row id plus ``cols``; a callable entry builds its Column only once a session exists."""
    return lambda spark, sf_dir: observations(spark, sf_dir).select(
        "obs_id", *[c() if callable(c) else c for c in cols])


def _obs_rows(slice_fn) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: slice_fn(observations(spark, sf_dir)).select("obs_id")


def _normalized_ns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows with ``time`` stored as epoch nanoseconds, read back as a timestamp."""
    ensure_utc(spark)
    raw = fixtures.grid_raw(spark, sf_dir)
    as_ns = raw.select("obs_id", (F.unix_micros("time") * 1000).alias("time"))
    return normalize_time(as_ns, "time")


def _transform_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir)
    return obs.withColumn("wind_dir", stable_round("wind_dir", 6))


def _dewpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = fixtures.table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return ev.select("event_id", dewpoint_magnus(F.lit(10.0) + eid % 20, (eid % 100).cast("double")).alias("dewpoint_c"))


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_payload(fixtures.station_payloads(spark, sf_dir), "payload", "location", "observed_at")


def _distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir)
    # one-row carrier for the two lazy scalar subqueries that scan the observations
    return spark.range(1).select(
        distinct_count(obs, "latitude", "longitude").alias("n_cells"),
        distinct_count(obs, "year").alias("n_years"),
    )


def _float32_wind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wind of a grid that is stored in single precision."""
    raw = fixtures.grid_raw(spark, sf_dir)
    stored = raw.withColumns({c: F.col(c).cast("float") for c in ("u10", "v10")})
    return transform(stored).select("obs_id", "wind_speed")


def _zone_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 over a transformed zone that is written to the shared folder and read back."""
    path = f"{scratch_folder(spark, 'zone')}/transformed"
    write_transformed(observations(spark, sf_dir).drop("obs_id"), path)
    return marts.hourly_conditions(read_transformed(spark, path))


def _box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a box, read from a written zone by ranges of cell ids."""
    path = f"{scratch_folder(spark, 'zone')}/transformed"
    write_transformed(observations(spark, sf_dir).drop("obs_id"), path)
    return in_box(read_transformed(spark, path), *oracle.BOX).groupBy((F.col("latitude") + 0.0).alias("latitude"), (F.col("longitude") + 0.0).alias("longitude")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("hour").alias("sum_hours"))


def _approx_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell-hours by year: sketches against exact counts, and all years from the merged sketches."""
    obs = observations(spark, sf_dir)
    keys = ("latitude", "longitude", "time")
    by_year = obs.groupBy("year").agg(F.count_distinct(F.struct(*keys)).alias("n_cell_hours"), distinct_sketch(*keys).alias("sketch"))
    total = by_year.agg(F.lit(-1).alias("year"), distinct_count(obs, *keys).alias("n_cell_hours"), merged_count("sketch").alias("estimate"))
    each = by_year.select("year", "n_cell_hours", F.hll_sketch_estimate("sketch").alias("estimate"))
    close = F.abs(F.col("estimate") - F.col("n_cell_hours")) <= 0.03 * F.col("n_cell_hours")
    return each.unionByName(total).select("year", "n_cell_hours", close.alias("within_3_percent"))


def _mixed_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw zone whose years differ in physical types: time as timestamp (INT64, INT96) or epoch
    nanoseconds, coordinates in single or double precision."""
    ensure_utc(spark)
    path = f"{scratch_folder(spark, 'raw')}/raw"
    raw = fixtures.grid_raw(spark, sf_dir).withColumn("year", F.year("time"))
    single = raw.withColumns({c: F.col(c).cast("float") for c in ("latitude", "longitude")})
    kinds = [(raw, "INT96"), (single, "TIMESTAMP_MICROS"), (raw.withColumn("time", F.unix_micros("time") * 1000), "TIMESTAMP_MICROS")]
    for i, (rows, time_type) in enumerate(kinds):
        with session_settings(spark, {"spark.sql.parquet.outputTimestampType": time_type}):
            rows.filter(F.pmod("year", F.lit(3)) == i).write.mode("append").partitionBy("year").parquet(path)
    return transform(read_raw(spark, path)).select(
        "obs_id", "time", "latitude", "longitude", "year", "month", "hour", "temp_c", "wind_speed", "flying_category")


def _nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    # nearest_cells reads the sites twice; the events behind them are parsed once
    sites = stored(scored_events(spark, sf_dir).select("location", "lat", "lon").distinct(), "sites")
    return nearest_cells(sites, grid_positions(observations(spark, sf_dir)), within=oracle.SITE_REACH)


def _nearest_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nearest(spark, sf_dir).select(
        "location", "lat", "lon", "cell_latitude", "cell_longitude", stable_round("cell_distance", 6).alias("cell_distance"))


def _site_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    # stored, so that neither the observations nor the events are shuffled to meet a few sites
    baseline = stored(site_baseline(observations(spark, sf_dir), stored(_nearest(spark, sf_dir), "nearest")), "baseline")
    return views.versus_baseline(scored_events(spark, sf_dir), baseline)


def _sliding_counts(scored: DataFrame) -> DataFrame:
    windows = scored.filter("event_time IS NOT NULL").groupBy(F.window("event_time", "10 minutes", "5 minutes"), "location")
    return views.flatten_window(windows.agg(F.count(F.lit(1)).alias("n_events")))


def _rank_blh(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir).select("obs_id", "blh")
    return global_rank(obs, "blh", ascending=False, nulls_last=True, alias="blh_rank", result_type="bigint")


def _operator_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    scored = scored_events
    return {
        "a2_normalize_time": _normalized_ns,
        "b1_calendar": _obs_cols("year", "month", "day", "hour"),
        "b2_celsius": _obs_cols("temp_c", "dewpoint_c"),
        "b3_wind_speed": _obs_cols("wind_speed"),
        "b3_wind_speed_float32": _float32_wind,
        "e8_corr": _mart(lambda o: o.groupBy("month").agg(stable_round(safe_corr("cape", "blh"), 6).alias("cape_blh_corr"))),
        "i3_sliding": _live(_sliding_counts),
        "b4_wind_dir": _obs_cols(lambda: stable_round("wind_dir", 6).alias("wind_dir")),
        "b5_cloud_base_fog": _obs_cols("cloud_base_m", "fog_condition"),
        "b7_flying_category": _obs_cols("flying_category"),
        "b8_thermal_strength": _obs_cols("thermal_strength"),
        "b9_time_of_day": _obs_cols("hour", "time_of_day"),
        "b10_season": _obs_cols("month", "season"),
        "b11_transform": _transform_all,
        "b12_danger_flag": _obs_cols(lambda: danger_flag().alias("dangerous")),
        "b13_xc_flag": _obs_cols(lambda: xc_flag().alias("xc_suitable")),
        "b15_flying_score": lambda spark, sf_dir: scored(spark, sf_dir).select(
            "timestamp", "location", "wind_speed", "cloud_base_m", "cloud_cover", "flying_score", "flyable"),
        "b17_alert": lambda spark, sf_dir: scored(spark, sf_dir).select(
            "timestamp", "location", "wind_speed", "wind_gust", "cloud_base_m", alert_level().alias("alert")),
        "b22_dewpoint_magnus": _dewpoint,
        "b23_parse_payload": _payloads,
        "b24_parse_events": lambda spark, sf_dir: parse_events(fixtures.event_messages(spark, sf_dir)),
        "c1_season_months": lambda spark, sf_dir: in_months(observations(spark, sf_dir)).select("obs_id", "month"),
        "c2_midday_hours": _obs_rows(flying_hours),
        "c3_daylight_hours": _obs_rows(lambda o: flying_hours(o, hours=(6, 21))),
        "c4_flyable_daylight": _obs_rows(lambda o: flying_hours(o, hours=(6, 21), flyable_only=True)),
        "c5_diurnal_slice": _obs_rows(diurnal_slice),
        "e9_distinct_counts": _distinct_counts,
        "f2_global_rank": _rank_blh,
        "d1_cell_ids": lambda spark, sf_dir: add_cell_id(observations(spark, sf_dir)).select("obs_id", "cell_id"),
        "c7_box": _box,
        "e9_approx_distinct": _approx_distinct,
        "q2_from_year_moments": _mart(lambda o: marts.rank_cells(merged_conditions(cell_moments(o)))),
        "q5_from_year_moments": _mart(lambda o: merged_correlation(month_moments(o))),
        "a1_mixed_zone": _mixed_zone,
        "s4_nearest_cells": _nearest_cells,
        "s4_site_baseline": _site_baseline,
        "a11_encode_events": lambda spark, sf_dir: fixtures.event_messages(spark, sf_dir),
    }


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: Q3 hourly conditions over the sf0.001 tables."""
    return marts.hourly_conditions(observations(spark, SMOKE_DIR))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "q1_category_hours_by_month": _mart(marts.category_hours_by_month),
        "q2_cell_stability": _mart(marts.cell_stability),
        "q2_top10_stable": _mart(lambda o: marts.top_stable_cells(marts.cell_stability(o))),
        "q2_top10_unstable": _mart(lambda o: marts.top_unstable_cells(marts.cell_stability(o))),
        "q3_hourly_conditions": _mart(marts.hourly_conditions),
        "q4_category_by_hour": _mart(marts.category_by_hour),
        "q5_cape_cloudbase_corr": _mart(marts.cape_cloudbase_correlation),
        "q6_danger_by_season": _mart(marts.danger_by_season),
        "q7_xc_months": _mart(marts.xc_months),
        "q8_morning_to_afternoon": _mart(marts.morning_to_afternoon),
        "q9_blh_through_day": _mart(marts.blh_through_day),
        "q10_climate_trend": _mart(marts.climate_trend),
        "s1_location_windows": _live(views.location_windows),
        "s2_wind_trend": _live(views.wind_trend),
        "s3_alerts": _live(views.point_alerts),
        "s4_vs_baseline": _vs_baseline,
        "d1_cell_day_join": _mart(marts.joined_cell_days),
        "q8_cell_day_outlook": _mart(marts.cell_day_outlook),
        "a4_zone_round_trip": _zone_round_trip,
        **_operator_queries(),
        **(llm.queries() | {"pipeline": corpus_pipeline.run} if llm else {}),
    }


def oracle_sql() -> dict[str, str]:
    sql = dict(oracle.QUERIES)
    if llm:
        sql |= llm.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
