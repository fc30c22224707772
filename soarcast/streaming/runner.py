"""Start the live views as Structured Streaming queries.

Three queries cover the five reference sinks:

* ``windows``    S1 tumbling means (stateful), one result fanned out to both of its sinks
                 (the reference computed the same aggregation twice);
* ``wind_trend`` S2 sliding windows with alerts (stateful);
* ``points``     S3 alerts and S4 baseline comparison (stateless), plus rejected
                 events (no time or no site) to a dead-letter sink.

Every query has its own checkpoint under ``checkpoint_dir`` (default: a ``live``
folder in the cluster's ``spark.checkpoint.dir``), so offsets and window state survive
restarts and lost executors. Windowed queries run in append mode: a window is
written once, after the watermark passes its end; later rows for it are dropped.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions import rules as R
from ..session import checkpoint_root, session_settings
from ..sources.events import parse_events, read_events, split_valid
from .sinks import BatchWriter, fan_out
from .views import drop_replays, location_windows, point_alerts, score_events, versus_baseline, wind_trend

_STATE_PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Sink names of the reference deployment.
SINK_NAMES = ("weather_stream", "location_comparison", "wind_trend", "weather_alerts", "historical_comparison",
              "rejected_events")


@dataclass
class LiveQueries:
    spark: SparkSession
    queries: dict[str, StreamingQuery] = field(default_factory=dict)

    def await_any(self, timeout: float | None = None) -> bool:
        """Block until any query stops; a failed query re-raises its error here."""
        return self.spark.streams.awaitAnyTermination(timeout)

    def process_all_available(self) -> None:
        for q in self.queries.values():
            q.processAllAvailable()

    def stop(self) -> None:
        for q in self.queries.values():
            q.stop()


def _writer(sinks: Mapping[str, BatchWriter], *names: str) -> BatchWriter | None:
    chosen = [sinks[n] for n in names if n in sinks]
    return fan_out(*chosen) if chosen else None


def _point_writer(baseline, sinks: Mapping[str, BatchWriter], strict_nulls: bool) -> BatchWriter:
    alerts_w = sinks.get("weather_alerts")
    compare_w = sinks.get("historical_comparison")
    rejected_w = sinks.get("rejected_events")

    def write(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.persist()
        try:
            valid, rejected = split_valid(batch_df)
            scored = score_events(valid.drop("message"), strict_nulls)
            if alerts_w:
                alerts_w(point_alerts(scored, strict_nulls), batch_id)
            if compare_w:
                # a loader is called per micro-batch, so a rewritten mart is picked up
                base = baseline() if callable(baseline) else baseline
                compare_w(versus_baseline(scored, base, strict_nulls), batch_id)
            if rejected_w:
                # the message as it came, not the columns that could not be read from it
                rejected_w(rejected.select("message.*"), batch_id)
        finally:
            batch_df.unpersist()

    return write


def start_live(
    spark: SparkSession,
    source,
    baseline,
    sinks: Mapping[str, BatchWriter],
    checkpoint_dir: str | None = None,
    trigger: dict | None = None,
    max_files_per_trigger: int | None = None,
    state_store: str = "rocksdb",
    state_partitions: int | None = None,
    strict_nulls: bool = False,
    deduplicate: bool = False,
) -> LiveQueries:
    """Start the live queries over ``source`` (Kafka options or a JSON-lines folder).

    ``baseline`` is ``operators.hourly_baseline(q3 mart)``, or a zero-argument function
    returning it; a function is called for every micro-batch, so the comparison follows
    a mart that the batch job rewrites without a restart. ``sinks`` maps names from
    ``SINK_NAMES`` to writers; ``trigger`` is passed to ``DataStreamWriter.trigger``
    (default every 2 minutes; ``{"availableNow": True}`` for a catch-up run).
    ``state_store="rocksdb"`` selects the RocksDB state store unless the session
    already names one; the provider of an existing checkpoint cannot change.
    ``state_partitions`` sets the number of state partitions of the windowed queries
    at their first start (kept in the checkpoint afterwards); the session's
    ``spark.sql.shuffle.partitions`` is used when it is not given. ``strict_nulls`` gives NULL
    labels and scores where an input is NULL. ``deduplicate`` drops events that a producer sent
    again (``views.drop_replays``), within each query's watermark; it adds state to every query, so
    it cannot be switched for an existing checkpoint.
    """
    if "historical_comparison" in sinks and baseline is None:
        raise ValueError("the historical_comparison sink needs a baseline (see operators.hourly_baseline)")
    root = (checkpoint_dir or f"{checkpoint_root(spark)}/live").rstrip("/")
    settings = {"spark.sql.session.timeZone": "UTC"}
    if state_store == "rocksdb" and not spark.conf.get(_STATE_PROVIDER_KEY, None):
        # window state lives off-heap and is checkpointed incrementally
        settings[_STATE_PROVIDER_KEY] = _ROCKSDB_PROVIDER
    # a query keeps a copy of the session it was started in, so these can be put back after
    with session_settings(spark, settings):
        return _start(spark, source, baseline, sinks, root, trigger, max_files_per_trigger, state_partitions, strict_nulls, deduplicate)


def _start(spark, source, baseline, sinks, root, trigger, max_files_per_trigger, state_partitions, strict_nulls, deduplicate) -> LiveQueries:
    trigger = trigger or {"processingTime": "2 minutes"}
    events = parse_events(read_events(spark, source, max_files_per_trigger), keep_message=True)
    valid, _ = split_valid(events.drop("message"))

    def scored(delay: str) -> dict:
        """Events with their score, and the watermark that their view still has to set."""
        rows = drop_replays(valid, delay) if deduplicate else valid
        return {"scored": score_events(rows, strict_nulls), "watermark": None if deduplicate else delay}

    plans = {
        "windows": (location_windows(**scored(R.TUMBLING_WATERMARK)), _writer(sinks, "weather_stream", "location_comparison")),
        "wind_trend": (wind_trend(**scored(R.SLIDING_WATERMARK), strict_nulls=strict_nulls), _writer(sinks, "wind_trend")),
    }
    if any(n in sinks for n in ("weather_alerts", "historical_comparison", "rejected_events")):
        plans["points"] = (drop_replays(events) if deduplicate else events, _point_writer(baseline, sinks, strict_nulls))

    # forget queries that ended earlier in this session, so await_any waits on these
    spark.streams.resetTerminated()
    live = LiveQueries(spark)
    saved = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for name, (frame, writer) in plans.items():
            if writer is None:
                continue
            if state_partitions and (deduplicate or name in ("windows", "wind_trend")):
                spark.conf.set("spark.sql.shuffle.partitions", str(int(state_partitions)))
            live.queries[name] = (
                frame.writeStream.queryName(f"live_{name}")
                .outputMode("append")
                .option("checkpointLocation", f"{root}/{name}")
                .foreachBatch(writer)
                .trigger(**trigger)
                .start()
            )
            spark.conf.set("spark.sql.shuffle.partitions", saved)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", saved)
    return live
