"""Supervision of live queries: their progress, late rows and failures as a table, and restarts.

``ProgressLog`` listens to the session's queries and keeps one small row for every micro-batch
and every end of a query; ``flush`` appends them to a Parquet table on shared storage. ``supervise``
runs live queries, restarts them from their checkpoints after a failure with growing pauses, and
gives up after a number of failures in a row.
"""

from __future__ import annotations

import datetime as dt
import threading
import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from ..sources.publish import committed_batches
from .runner import LiveQueries

LOG_SCHEMA = (
    "at timestamp, kind string, query string, stream_id string, run_id string, batch bigint, input_rows bigint, late_rows bigint, "
    "state_rows bigint, watermark timestamp, lag_seconds double, batch_seconds double, error string")


def _time(text: str | None) -> dt.datetime | None:
    return dt.datetime.fromisoformat(text.replace("Z", "+00:00")) if text else None


class ProgressLog(StreamingQueryListener):
    """Rows of ``LOG_SCHEMA``: kind ``progress`` for a batch, ``failed`` and ``ended`` for the end of a
    query, ``restart`` and ``gave_up`` from ``supervise``.

    ``late_rows`` are rows that stateful operators dropped behind the watermark; ``lag_seconds`` is
    how far the latest event of a batch was behind the clock when the batch began.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._rows: list[tuple] = []
        self._names: dict[str, str] = {}
        self._lock = threading.Lock()
        self._flushed = 0

    def add(self, kind: str, query: str | None = None, stream_id: str | None = None, run_id: str | None = None, batch: int | None = None,
            input_rows: int | None = None, late_rows: int | None = None, state_rows: int | None = None, watermark=None, lag=None,
            seconds=None, error: str | None = None, at: dt.datetime | None = None) -> None:
        at = at or dt.datetime.now(dt.timezone.utc)
        with self._lock:
            self._rows.append((at, kind, query, stream_id, run_id, batch, input_rows, late_rows, state_rows, watermark, lag, seconds, error))

    def onQueryStarted(self, event) -> None:  # noqa: N802 (names of the interface)
        self._names[str(event.id)] = event.name

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        at, latest = _time(p.timestamp), _time(p.eventTime.get("max"))
        self.add(
            "progress", p.name, str(p.id), str(p.runId), p.batchId, p.numInputRows, sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
            sum(s.numRowsTotal for s in p.stateOperators), _time(p.eventTime.get("watermark")),
            (at - latest).total_seconds() if latest else None, p.batchDuration / 1000, at=at)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        error = event.exception
        self.add("failed" if error else "ended", self._names.get(str(event.id)), str(event.id), str(event.runId), error=error[:2000] if error else None)

    def flush(self) -> None:
        """Append the rows that came since the last flush; a few KB a minute, written as one file."""
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            folder = f"{self.path}/query_id=log-{id(self):x}-{time.time_ns()}/batch_id={self._flushed}"
            self.spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.parquet(folder)
            self._flushed += 1

    def read(self) -> DataFrame:
        """All flushed rows of this path, by whichever run."""
        root, _, table = self.path.rpartition("/")
        found = committed_batches(self.spark, root, table)
        return self.spark.createDataFrame([], LOG_SCHEMA) if found is None else found.drop("query_id", "batch_id")


def supervise(start: Callable[[], LiveQueries], log: ProgressLog, most_failures: int = 5, first_pause: float = 1.0, longest_pause: float = 300.0,
              poll: float = 5.0, pause: Callable[[float], None] = time.sleep) -> int:
    """Run the queries that ``start`` starts until they end by themselves; returns the number of restarts.

    When one fails, all are stopped and started again from their checkpoints: finished batches are not
    repeated, and the batch that failed is, whole. The pause doubles with each failure in a row, up to
    ``longest_pause``; a batch that finishes in between makes it short again. After ``most_failures``
    in a row the last error is raised.
    """
    spark, failures, restarts = log.spark, 0, 0
    spark.streams.addListener(log)
    try:
        while True:
            spark.streams.resetTerminated()
            live, batches = start(), 0
            try:
                while any(q.isActive for q in live.queries.values()):
                    live.await_any(poll)
                    spark.streams.resetTerminated()
                    log.flush()
                    batches = _finished(live)
                    _raise_failure(live)
                _raise_failure(live)
                return restarts
            except StreamingQueryException as error:
                failures = 1 if max(batches, _finished(live)) else failures + 1
                live.stop()
                spark.streams.resetTerminated()
                if failures >= most_failures:
                    log.add("gave_up", error=str(error)[:2000])
                    raise
                restarts += 1
                wait = min(first_pause * 2 ** (failures - 1), longest_pause)
                log.add("restart", lag=wait, error=str(error)[:2000])
                log.flush()
                pause(wait)
    finally:
        _drain(log)
        spark.streams.removeListener(log)
        log.flush()


def _raise_failure(live: LiveQueries) -> None:
    for q in live.queries.values():
        error = q.exception()
        if error:
            raise error


def _finished(live: LiveQueries) -> int:
    return sum(len(q.recentProgress) for q in live.queries.values())


def _drain(log: ProgressLog, seconds: float = 2.0) -> None:
    """Listener events come a little after the queries end: wait until no more arrive."""
    until, seen = time.time() + seconds, -1
    while time.time() < until and seen != len(log._rows):
        seen = len(log._rows)
        time.sleep(0.3)
