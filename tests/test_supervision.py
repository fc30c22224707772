"""Supervised live queries, replayed events and the strict switch."""

import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from test_streaming import SENTINEL, _messages_in_time_order, _rows, _sentinel, _write_files

from conftest import SF_SMALL
from soarcast.sources import fixtures
from soarcast.sources.events import parse_events
from soarcast.streaming import ProgressLog, drop_replays, parquet_batch_writer, start_live, supervise, views

S1 = ["location", "window_start", "window_end", "avg_wind", "avg_cloud_base", "avg_score"]
S2 = ["location", "window_start", "window_end", "avg_wind", "max_wind", "min_cloud_base", "wind_alert", "cloud_alert"]
LATE = json.dumps({"timestamp": "2024-01-01T00:00:01.000000", "location": "Vrsac", "wind_speed": 13.0, "wind_gust": 1.0,
                   "cloud_base_m": 1000.0, "cloud_cover": 0.1})


def _scored(spark):
    return views.score_events(parse_events(fixtures.event_messages(spark, SF_SMALL)))


def _sites(df):
    return df.filter(F.col("location") != SENTINEL)


def test_failures_and_late_rows_are_logged_and_queries_restarted(spark, scratch):
    msgs = _messages_in_time_order(spark)
    half = len(msgs) // 2
    source = os.path.join(scratch, "in")
    _write_files(source, [msgs[:half], msgs[half:], [_sentinel()], [LATE]], start_mtime=1_700_000_000)
    write, failures = parquet_batch_writer(scratch, "wind_trend"), ["first", "second"]

    def failing(batch_df, batch_id):
        if batch_id == 2 and failures:
            raise RuntimeError(f"sink down: {failures.pop(0)}")
        write(batch_df, batch_id)

    sinks = {"weather_stream": parquet_batch_writer(scratch, "weather_stream"), "wind_trend": failing}
    pauses, log = [], ProgressLog(spark, f"{scratch}/log")
    start = lambda: start_live(spark, source, None, sinks, checkpoint_dir=f"{scratch}/ckpt", trigger={"availableNow": True}, max_files_per_trigger=1)
    assert supervise(start, log, poll=1.0, pause=pauses.append) == 2
    assert len(pauses) == 2 and pauses[0] == 1.0
    # every window once, as in a batch, in spite of two failures
    for table, view, columns in (("weather_stream", views.location_windows, S1), ("wind_trend", views.wind_trend, S2)):
        assert _rows(_sites(spark.read.parquet(f"{scratch}/{table}")), columns) == _rows(view(_scored(spark)), columns)
    rows = log.read().collect()
    failed = [r for r in rows if r.kind == "failed"]
    assert [r.query for r in failed] == 2 * ["live_wind_trend"] and all("sink down" in r.error for r in failed)
    assert sum(r.kind == "restart" for r in rows) == 2
    late = {q: sum(r.late_rows for r in rows if r.kind == "progress" and r.query == q) for q in ("live_windows", "live_wind_trend")}
    assert late["live_windows"] == 1 and late["live_wind_trend"] >= 1
    progress = [r for r in rows if r.kind == "progress" and r.input_rows]
    assert all(r.batch_seconds > 0 and r.state_rows is not None for r in progress) and any(r.lag_seconds and r.lag_seconds > 0 for r in progress)


def test_supervision_gives_up_on_a_lasting_failure(spark, scratch):
    source = os.path.join(scratch, "in")
    _write_files(source, [_messages_in_time_order(spark)[:50]], start_mtime=1_700_000_000)

    def broken(batch_df, batch_id):
        raise RuntimeError("always down")

    pauses, log = [], ProgressLog(spark, f"{scratch}/log")
    start = lambda: start_live(spark, source, None, {"wind_trend": broken}, checkpoint_dir=f"{scratch}/ckpt", trigger={"availableNow": True})
    with pytest.raises(StreamingQueryException):
        supervise(start, log, most_failures=3, first_pause=0.5, longest_pause=0.8, poll=1.0, pause=pauses.append)
    assert pauses == [0.5, 0.8]
    kinds = [r.kind for r in log.read().collect()]
    assert kinds.count("restart") == 2 and kinds.count("gave_up") == 1
    assert ProgressLog(spark, f"{scratch}/nothing").read().count() == 0


def test_replayed_messages_count_once(spark, scratch):
    msgs = _messages_in_time_order(spark)
    chunks = [msgs[i:i + 250] for i in range(0, len(msgs), 250)]
    # the producer sends the end of each chunk again, at once and with the next one
    sent = [c + c[-40:] + (chunks[i - 1][-3:] if i else []) for i, c in enumerate(chunks)]
    source = os.path.join(scratch, "in")
    _write_files(source, [*sent, [_sentinel(), "{broken", "{broken", "{other"]], start_mtime=1_700_000_000)
    sinks = {n: parquet_batch_writer(scratch, n) for n in ("weather_stream", "wind_trend", "weather_alerts", "rejected_events")}
    live = start_live(spark, source, None, sinks, checkpoint_dir=f"{scratch}/ckpt", trigger={"availableNow": True}, max_files_per_trigger=1, deduplicate=True)
    for q in live.queries.values():
        q.awaitTermination(300)
    read = lambda name: _sites(spark.read.parquet(f"{scratch}/{name}"))
    assert _rows(read("weather_stream"), S1) == _rows(views.location_windows(_scored(spark)), S1)
    assert _rows(read("wind_trend"), S2) == _rows(views.wind_trend(_scored(spark)), S2)
    alerts = list(views.ALERT_COLUMNS)
    assert _rows(read("weather_alerts"), alerts) == _rows(views.point_alerts(_scored(spark)), alerts)
    assert spark.read.parquet(f"{scratch}/rejected_events").count() == 2
    # keys are forgotten behind the watermark: state holds minutes of events, not all of them
    held = [p["stateOperators"][-1]["numRowsTotal"] for p in live.queries["points"].recentProgress if p["stateOperators"]]
    assert held and max(held) < len(msgs) / 2
    batch = drop_replays(parse_events(spark.createDataFrame([(m,) for c in sent for m in c], "value string")))
    assert batch.count() == len(msgs)


def test_strict_nulls_reach_every_view(spark):
    rows = [{"timestamp": "2024-01-01T00:01:00", "location": "a", "wind_speed": None, "wind_gust": 1.0, "cloud_base_m": 100.0, "cloud_cover": 0.1},
            {"timestamp": "2024-01-01T00:02:00", "location": "b", "wind_speed": 3.0, "wind_gust": 1.0, "cloud_base_m": 900.0, "cloud_cover": 0.1}]
    events = parse_events(spark.createDataFrame([(json.dumps(r),) for r in rows], "value string"))
    strict, plain = views.score_events(events, strict_nulls=True), views.score_events(events)
    assert {r.location: r.flying_score is None for r in strict.collect()} == {"a": True, "b": False}
    assert views.point_alerts(strict, strict_nulls=True).count() == 0 and views.point_alerts(plain).count() == 1
    assert {r.wind_alert for r in views.wind_trend(strict, strict_nulls=True).filter("location = 'a'").collect()} == {None}
    base = spark.createDataFrame([(0, 4.0, 1000.0)], "hist_hour int, hist_wind double, hist_cloud_base double")
    assert {r.location: r.conditions_vs_avg for r in views.versus_baseline(strict, base, strict_nulls=True).collect()}["a"] is None
    assert {r.location: r.conditions_vs_avg for r in views.versus_baseline(plain, base).collect()}["a"] is not None
