"""Sources and sinks: grid zones, marts, live events and the test-data projections."""

from .events import encode_events, parse_events, parse_payload, read_events, split_valid, write_topic
from .fixtures import event_messages, grid_raw, station_payloads, table, weather_events
from .grid import flatten_cube, observations, read_raw, read_transformed, replace_year, replace_zone_year, replace_zone_years, write_transformed
from .marts import EXPORTED_MARTS, export_marts, mart_path, read_mart, write_mart
from .publish import Published, committed_batches

__all__ = [name for name in dir() if not name.startswith("_")]
