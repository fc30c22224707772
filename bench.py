"""Benchmark: the batch pipeline and the live views at one scale factor.

Runs the production path on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``:

  raw zone (from lineitem, partitioned by year=)  -- setup, not timed
  transform: raw zone -> transformed zone (year/month partitions)
  q1..q10: transformed zone -> mart folder, each from the zone by itself (month pruning
          applies); batch_marts_sec, beside the total, is all ten the way run_batch builds them
  s1..s4: event messages (JSON lines, one file per topic partition) -> parse -> live
          views in batch mode (a backfill), written as Parquet

Before timing, the same code runs once untimed over the smallest scale factor
(``$BENCH_WARMUP_DIR``, default /root/testdata/sf0.001; set it empty to skip), so JIT
and code generation are warm and the numbers reflect steady-state throughput.

The live queries are also run once as a catch-up stream (``availableNow``); that time
and the events per second are reported next to, not inside, the total.

The timed pass runs ``$BENCH_REPEATS`` times (default 3) on fresh folders; each query
reports its median, and the total is the sum of the medians.

Prints ONE JSON line: {"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}.
Scratch output goes under the session's checkpoint folder (a fresh sub-folder per run).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from soarcast.functions import transform  # noqa: E402
from soarcast.operators import hourly_baseline  # noqa: E402
from soarcast.plans import CALENDAR_MARTS, build_marts, marts  # noqa: E402
from soarcast.session import build_session, scratch_folder  # noqa: E402
from soarcast.sources import fixtures, read_mart, read_raw, read_transformed, write_mart, write_transformed  # noqa: E402
from soarcast.sources.events import parse_events  # noqa: E402
from soarcast.streaming import SINK_NAMES, parquet_batch_writer, start_live, views  # noqa: E402

MART_KEYS = [
    ("q1", "q1_flying_hours_by_month"),
    ("q2", "q2_location_stability"),
    ("q3", "q3_hourly_conditions"),
    ("q4", "q4_hourly_by_category"),
    ("q5", "q5_cape_cloudbase_correlation"),
    ("q6", "q6_dangerous_conditions"),
    ("q7", "q7_xc_best_months"),
    ("q8", "q8_afternoon_prediction"),
    ("q9", "q9_blh_development"),
    ("q10", "q10_climate_trend"),
]


def run_all(spark, sf_dir: str, work: str, cpus: int) -> dict[str, float]:
    paths = (f"{work}/{p}" for p in ("raw", "transformed", "marts", "live", "messages"))
    raw_path, zone_path, mart_root, live_root, msg_path = paths

    # setup (untimed): the raw zone as the ingest step leaves it, one folder per year
    raw = fixtures.grid_raw(spark, sf_dir).drop("obs_id")
    raw.withColumn("year", F.year("time")).write.mode("overwrite").partitionBy("year").parquet(raw_path)
    spark.read.parquet(raw_path).count()  # warm the file listing cache
    # setup (untimed): event messages as they sit in a topic with one file per partition
    fixtures.event_messages(spark, sf_dir).select("value").repartition(cpus).write.mode("overwrite").text(msg_path)

    timings: dict[str, float] = {}

    t0 = time.perf_counter()
    write_transformed(transform(read_raw(spark, raw_path)), zone_path)
    timings["transform"] = time.perf_counter() - t0

    obs = read_transformed(spark, zone_path)
    for key, name in MART_KEYS:
        t0 = time.perf_counter()
        write_mart(marts.MARTS[name](obs), mart_root, name, one_file=name in CALENDAR_MARTS)
        timings[key] = time.perf_counter() - t0

    # what run_batch does for all ten: one rollup scan, shared counts, cells written once
    t0 = time.perf_counter()
    build_marts(spark, obs, f"{mart_root}_batch")
    batch_sec = time.perf_counter() - t0

    messages = spark.read.text(msg_path)
    baseline = hourly_baseline(read_mart(spark, mart_root, "q3_hourly_conditions"))
    live = {
        "s1": views.location_windows,
        "s2": views.wind_trend,
        "s3": views.point_alerts,
        "s4": lambda s: views.versus_baseline(s, baseline),
    }
    for key, build in live.items():
        t0 = time.perf_counter()
        scored = views.score_events(parse_events(messages))
        build(scored).write.mode("overwrite").parquet(f"{live_root}/{key}")
        timings[key] = time.perf_counter() - t0

    # informational, not in the total: the three live queries as a catch-up stream
    sinks = {name: parquet_batch_writer(f"{work}/stream_out", name) for name in SINK_NAMES}
    t0 = time.perf_counter()
    stream = start_live(spark, msg_path, baseline, sinks, checkpoint_dir=f"{work}/stream_ckpt",
                        trigger={"availableNow": True})
    for q in stream.queries.values():
        q.awaitTermination()
    stream_sec = time.perf_counter() - t0
    n_events = messages.count()
    return timings, {"stream_sec": round(stream_sec, 3), "stream_events_per_sec": round(n_events / stream_sec),
                     "batch_marts_sec": round(batch_sec, 3)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(
        f"local[{cpus}]",
        app_name="soarcast-bench",
        shuffle_partitions=max(cpus, 1),
        extra={
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    run_id = uuid.uuid4().hex[:8]
    # spark.checkpoint.dir; only a local session may do without (a new folder then)
    root = scratch_folder(spark, "bench")
    warmup_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if warmup_dir:
        run_all(spark, warmup_dir, f"{root}/bench-{run_id}-warmup", cpus)
    repeats = max(1, int(os.environ.get("BENCH_REPEATS", "3")))
    runs = [run_all(spark, sf_dir, f"{root}/bench-{run_id}-{i}", cpus) for i in range(repeats)]
    timings = {k: statistics.median(r[0][k] for r in runs) for k in runs[0][0]}
    stream = {"stream_sec": statistics.median(r[1]["stream_sec"] for r in runs)}
    stream["batch_marts_sec"] = statistics.median(r[1]["batch_marts_sec"] for r in runs)
    stream["stream_events_per_sec"] = statistics.median(r[1]["stream_events_per_sec"] for r in runs)

    sf = re.search(r"sf([0-9.]+)", sf_dir)
    total = sum(timings.values())
    print(json.dumps({
        "metric": "total_wall_seconds",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in timings.items()},
        "sf": float(sf.group(1)) if sf else sf_dir,
        "cpus": cpus,
        "repeats": repeats,
        **stream,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
