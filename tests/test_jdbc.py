"""JDBC sinks and export without a database: the writer call is recorded instead.

No database server may run here, so ``DataFrameWriter.jdbc`` is replaced by a recorder
that runs an action on the frame (as a real write would) and keeps its rows.
"""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from conftest import SF_SMALL
from soarcast.plans import MARTS
from soarcast.sources import EXPORTED_MARTS, export_marts, fixtures, write_mart
from soarcast.functions import transform
from soarcast.streaming import has_retry_columns, jdbc_batch_writer


@pytest.fixture()
def recorded(monkeypatch):
    calls = []

    def fake_jdbc(self, url, table, mode=None, properties=None):
        calls.append({"url": url, "table": table, "mode": mode, "properties": properties,
                      "columns": self._df.columns, "rows": self._df.collect()})

    monkeypatch.setattr(DataFrameWriter, "jdbc", fake_jdbc)
    return calls


def test_stream_sink_flattens_windows_and_appends(spark, recorded):
    df = spark.createDataFrame([("Vrsac", dt.datetime(2024, 1, 1, 0, 7), 3.0)], "location string, t timestamp, w double")
    batch = df.groupBy(F.window("t", "5 minutes"), "location").agg(F.avg("w").alias("avg_wind"))
    jdbc_batch_writer("weather_stream", "jdbc:x", {"user": "u"})(batch, 7)
    statements = []
    once = jdbc_batch_writer("wind_trend", "jdbc:x", {"user": "u"}, run_statement=lambda sql, table: statements.append((sql, table)))
    once(batch, 8)
    once(batch, 8)  # a retried batch deletes what its first attempt left
    first, second, _ = recorded
    assert statements == 2 * [("DELETE FROM wind_trend WHERE batch_id = 8 AND query_id = 'batch'", "wind_trend")]
    assert first["mode"] == "append" and first["table"] == "weather_stream"
    assert first["columns"] == ["location", "avg_wind", "window_start", "window_end"]
    assert second["columns"][-2:] == ["batch_id", "query_id"] and second["rows"][0]["batch_id"] == 8


def test_export_marts_writes_the_eight_tables_with_counts(spark, recorded, scratch):
    obs = transform(fixtures.grid_raw(spark, SF_SMALL))
    for name in EXPORTED_MARTS:
        write_mart(MARTS[name](obs), scratch, name)
    counts = export_marts(spark, scratch, "jdbc:x", {"user": "u"})
    assert set(counts) == set(EXPORTED_MARTS.values()) and len(counts) == 8
    assert all(c["mode"] == "overwrite" for c in recorded)
    assert {c["table"]: len(c["rows"]) for c in recorded} == counts


class _Rows:
    def __init__(self, rows):
        self.rows, self.at = rows, -1

    def next(self):
        self.at += 1
        return self.at < len(self.rows)

    def getString(self, name):  # noqa: N802
        return self.rows[self.at][name]


class _Meta:
    """Database metadata that compares names with case and takes them as patterns, as drivers do."""

    def __init__(self, tables):
        self.tables, self.schemas = tables, []

    def getTables(self, catalog, schema, name, kinds):  # noqa: N802
        self.schemas.append(schema)
        like = lambda t: len(t) == len(name) and all(p in ("_", c) for p, c in zip(name, t))
        return _Rows([{"TABLE_NAME": t} for t in self.tables if like(t)])

    def getColumns(self, catalog, schema, name, column):  # noqa: N802
        return _Rows([{"COLUMN_NAME": c} for c in self.tables[name]])


@pytest.mark.parametrize("stored", ["wind_trend", "WIND_TREND"])
def test_tables_are_found_however_the_database_folds_names(stored):
    meta = _Meta({stored: ["LOCATION", "BATCH_ID", "Query_id"], "windXtrend": []})
    assert has_retry_columns(meta, "wind_trend") and has_retry_columns(meta, "Wind_Trend")
    assert not has_retry_columns(meta, "weather_stream")
    assert has_retry_columns(meta, "live.wind_trend") and meta.schemas[-1] in ("live", "LIVE")
    with pytest.raises(ValueError, match="without batch_id and query_id"):
        has_retry_columns(_Meta({stored: ["location"]}), "wind_trend")
