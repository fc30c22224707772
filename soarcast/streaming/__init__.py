"""Live views (batch or streaming) and the streaming runner."""

from .views import (
    drop_replays,
    flatten_window,
    location_windows,
    point_alerts,
    score_events,
    versus_baseline,
    wind_trend,
)
from .runner import SINK_NAMES, LiveQueries, start_live
from .sinks import fan_out, has_retry_columns, jdbc_batch_writer, jdbc_statement, parquet_batch_writer, query_id
from .supervisor import LOG_SCHEMA, ProgressLog, supervise

__all__ = [name for name in dir() if not name.startswith("_")]
