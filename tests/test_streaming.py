"""Structured Streaming runs of the live views equal their batch results."""

import json
import os
import time

from pyspark.sql import functions as F

from conftest import SF_SMALL
from soarcast.operators import hourly_baseline
from soarcast.plans import marts
from soarcast.sources import fixtures
from soarcast.sources.events import encode_events, parse_events
from soarcast.streaming import parquet_batch_writer, start_live, views
from soarcast.streaming.runner import SINK_NAMES

SENTINEL = "ZZ_flush"


def _write_files(folder, lines_per_file, start_mtime):
    os.makedirs(folder, exist_ok=True)
    for i, lines in enumerate(lines_per_file):
        path = os.path.join(folder, f"part-{start_mtime + i:012d}.json")
        with open(path, "w") as fh:
            fh.write("\n".join(lines) + "\n")
        os.utime(path, (start_mtime + i, start_mtime + i))


def _messages_in_time_order(spark):
    typed = fixtures.weather_events(spark, SF_SMALL).orderBy("timestamp")
    return [r.value for r in encode_events(typed).select("value").collect()]


def _sentinel(ts="2030-01-01T00:00:00.000000"):
    return json.dumps({"timestamp": ts, "location": SENTINEL, "wind_speed": 1.0, "cloud_base_m": 1000.0,
                       "cloud_cover": 0.1})


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def _run(spark, source, sinks_root, ckpt, baseline):
    sinks = {name: parquet_batch_writer(sinks_root, name) for name in SINK_NAMES}
    live = start_live(spark, source, baseline, sinks, checkpoint_dir=ckpt, trigger={"availableNow": True},
                      max_files_per_trigger=1)
    for q in live.queries.values():
        q.awaitTermination(300)
    return live


def test_live_queries_equal_batch_views(spark, scratch):
    msgs = _messages_in_time_order(spark)
    chunks = [msgs[i:i + 200] for i in range(0, len(msgs), 200)]
    chunks.append([_sentinel(), "{broken json"])
    source = os.path.join(scratch, "in")
    _write_files(source, chunks, start_mtime=1_700_000_000)

    baseline = hourly_baseline(marts.hourly_conditions(
        __import__("__spark_entry__").observations(spark, SF_SMALL)))
    out, ckpt = os.path.join(scratch, "out"), os.path.join(scratch, "ckpt")
    _run(spark, source, out, ckpt, baseline)

    scored = views.score_events(parse_events(fixtures.event_messages(spark, SF_SMALL)))
    read = lambda name: spark.read.parquet(os.path.join(out, name)).filter(F.col("location") != SENTINEL)  # noqa

    s1_cols = ["location", "window_start", "window_end", "avg_wind", "avg_cloud_base", "avg_score"]
    batch_s1 = _rows(views.location_windows(scored), s1_cols)
    assert _rows(read("weather_stream"), s1_cols) == batch_s1
    assert _rows(read("location_comparison"), s1_cols) == batch_s1

    s2_cols = ["location", "window_start", "window_end", "avg_wind", "max_wind", "avg_cloud_base",
               "min_cloud_base", "avg_score", "wind_alert", "cloud_alert"]
    assert _rows(read("wind_trend"), s2_cols) == _rows(views.wind_trend(scored), s2_cols)

    s3_cols = list(views.ALERT_COLUMNS)
    assert _rows(read("weather_alerts"), s3_cols) == _rows(views.point_alerts(scored), s3_cols)

    s4_cols = list(views.BASELINE_COLUMNS)
    assert _rows(read("historical_comparison"), s4_cols) == _rows(views.versus_baseline(scored, baseline), s4_cols)

    rejected = spark.read.parquet(os.path.join(out, "rejected_events"))
    assert rejected.count() == 1

    # restart from the checkpoint with one late event: windows drop it, point views keep it
    late = json.dumps({"timestamp": "2024-01-01T00:00:01.000000", "location": "Vrsac", "wind_speed": 13.0,
                       "wind_gust": 1.0, "cloud_base_m": 1000.0, "cloud_cover": 0.1})
    _write_files(source, [[late]], start_mtime=1_800_000_000)
    live = _run(spark, source, out, ckpt, baseline)
    assert _rows(read("weather_stream"), s1_cols) == batch_s1
    alerts = read("weather_alerts").filter(F.col("timestamp") == "2024-01-01T00:00:01.000000")
    assert alerts.count() == 1
    progress = live.queries["windows"].recentProgress
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for p in progress for op in p["stateOperators"])
    assert dropped == 1
    metrics = [k for p in progress for op in p["stateOperators"] for k in op.get("customMetrics", {})]
    assert any(k.startswith("rocksdb") for k in metrics)  # window state kept in RocksDB


def test_parquet_sink_is_idempotent_per_batch(spark, scratch):
    df = spark.range(5).withColumn("location", F.lit("x"))
    write = parquet_batch_writer(scratch, "t")
    write(df, 3)
    write(df, 3)  # a retried batch replaces its own folder
    write(df, 4)
    out = spark.read.parquet(os.path.join(scratch, "t"))
    assert out.count() == 10 and sorted(r.batch_id for r in out.select("batch_id").distinct().collect()) == [3, 4]


def test_watermark_drops_out_of_order_rows(spark, scratch):
    """Shuffled arrival order: rows behind the watermark are dropped, never double counted."""
    msgs = _messages_in_time_order(spark)
    reversed_chunks = [msgs[i:i + 250] for i in range(0, len(msgs), 250)][::-1]
    source = os.path.join(scratch, "in")
    _write_files(source, reversed_chunks + [[_sentinel()]], start_mtime=int(time.time()) - 10_000)
    out = os.path.join(scratch, "out")
    sinks = {"weather_stream": parquet_batch_writer(out, "weather_stream")}
    live = start_live(spark, source, None, sinks, checkpoint_dir=os.path.join(scratch, "ckpt"),
                      trigger={"availableNow": True}, max_files_per_trigger=1)
    for q in live.queries.values():
        q.awaitTermination(300)
    got = spark.read.parquet(os.path.join(out, "weather_stream")).filter(F.col("location") != SENTINEL)
    scored = views.score_events(parse_events(fixtures.event_messages(spark, SF_SMALL)))
    batch = views.location_windows(scored)
    assert 0 < got.count() < batch.count()
    keys = ["location", "window_start"]
    assert got.select(*keys).distinct().count() == got.count()


def test_a_failing_sink_surfaces_in_await_any(spark, scratch):
    import pytest
    from pyspark.errors import StreamingQueryException

    source = os.path.join(scratch, "in")
    _write_files(source, [_messages_in_time_order(spark)[:50]], start_mtime=1_700_000_000)

    def broken(batch_df, batch_id):
        raise RuntimeError("sink down")

    live = start_live(spark, source, None, {"wind_trend": broken}, checkpoint_dir=os.path.join(scratch, "ckpt"),
                      trigger={"availableNow": True})
    with pytest.raises(StreamingQueryException):
        live.await_any(120)
    live.stop()
    spark.streams.resetTerminated()


def test_comparison_sink_requires_a_baseline(spark, scratch):
    import pytest

    with pytest.raises(ValueError):
        start_live(spark, scratch, None, {"historical_comparison": parquet_batch_writer(scratch, "x")},
                   checkpoint_dir=os.path.join(scratch, "ckpt"))


def test_state_partitions_are_set_per_query(spark, scratch):
    source = os.path.join(scratch, "in")
    _write_files(source, [_messages_in_time_order(spark)[:100]], start_mtime=1_700_000_000)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    live = start_live(spark, source, None, {"wind_trend": parquet_batch_writer(scratch, "wt")},
                      checkpoint_dir=os.path.join(scratch, "ckpt"), trigger={"availableNow": True},
                      state_partitions=3)
    for q in live.queries.values():
        q.awaitTermination(120)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    ops = [op for p in live.queries["wind_trend"].recentProgress for op in p["stateOperators"]]
    assert ops and all(op["numShufflePartitions"] == 3 for op in ops)
