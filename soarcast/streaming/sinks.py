"""Micro-batch writers for ``writeStream.foreachBatch``.

A writer is ``fn(batch_df, batch_id)``. ``window`` structs are flattened to
``window_start``/``window_end`` before writing, so relational targets get plain columns.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .views import flatten_window

BatchWriter = Callable[[DataFrame, int], None]
StatementRunner = Callable[[str, str], None]


def jdbc_batch_writer(table: str, url: str, properties: Mapping[str, str], run_statement: StatementRunner | None = None) -> BatchWriter:
    """Append each micro-batch to a database table (same columns as the view, with
    ``window`` flattened to ``window_start``/``window_end``).

    A database append alone is at-least-once. With ``run_statement`` (a function that runs one
    SQL statement, see ``jdbc_statement``) every row carries ``batch_id`` and ``query_id``, and
    a batch first deletes what an earlier attempt at it left: a retried batch is written once.
    The table needs both columns; it is created with them when it does not exist yet.
    """

    def write(batch_df: DataFrame, batch_id: int) -> None:
        df = flatten_window(batch_df)
        if run_statement:
            query = query_id(batch_df)
            run_statement(f"DELETE FROM {table} WHERE batch_id = {int(batch_id)} AND query_id = '{query}'", table)
            df = df.withColumns({"batch_id": F.lit(int(batch_id)), "query_id": F.lit(query)})
        df.write.jdbc(url=url, table=table, mode="append", properties=dict(properties))

    return write


def jdbc_statement(spark: SparkSession, url: str, properties: Mapping[str, str]) -> StatementRunner:
    """A runner of single statements on the driver's JDBC connection; a table that does not
    exist yet is left to the append, and one without the retry columns is an error."""

    def run(statement: str, table: str) -> None:
        jvm = spark.sparkContext._jvm
        settings = jvm.java.util.Properties()
        for k, v in properties.items():
            settings.setProperty(k, v)
        connection = jvm.java.sql.DriverManager.getConnection(url, settings)
        try:
            if has_retry_columns(connection.getMetaData(), table):
                connection.createStatement().executeUpdate(statement)
        finally:
            connection.close()

    return run


RETRY_COLUMNS = ("batch_id", "query_id")


def has_retry_columns(meta, table: str) -> bool:
    """Whether ``table`` exists, by a connection's ``DatabaseMetaData``; it must have the retry columns then.

    Databases fold names that are not quoted to upper or to lower case, so the name is looked for
    as it is given and in both foldings.
    """
    schema, _, name = table.rpartition(".")
    for fold in (str, str.upper, str.lower):
        found = meta.getTables(None, fold(schema) or None, fold(name), None)
        while found.next():
            real = found.getString("TABLE_NAME")
            if real.lower() != name.lower():  # the name is a pattern, in which _ stands for any character
                continue
            columns, named = meta.getColumns(None, fold(schema) or None, real, None), set()
            while columns.next():
                named.add(columns.getString("COLUMN_NAME").lower())
            missing = [c for c in RETRY_COLUMNS if c not in named]
            if missing:
                raise ValueError(f"table {table} exists without {' and '.join(missing)}, which exactly-once writes need; add them or drop run_statement")
            return True
    return False


def query_id(batch_df: DataFrame) -> str:
    """Id of the streaming query that runs this batch: the same after a restart from its
    checkpoint, another one for a new checkpoint. ``batch`` outside a query."""
    return batch_df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def parquet_batch_writer(root: str, table: str) -> BatchWriter:
    """Write each micro-batch to ``root/table/query_id=<id>/batch_id=<n>``, replacing that folder.

    A retried batch overwrites its own folder, so the table holds every batch exactly
    once (idempotent sink). Batch numbers restart with a new checkpoint, and so does the
    query's id: an earlier run's results stay. Reading ``root/table`` yields both columns.
    """
    base = f"{root.rstrip('/')}/{table}"

    def write(batch_df: DataFrame, batch_id: int) -> None:
        folder = f"{base}/query_id={query_id(batch_df)}/batch_id={int(batch_id)}"
        flatten_window(batch_df).write.mode("overwrite").parquet(folder)

    return write


def fan_out(*writers: BatchWriter) -> BatchWriter:
    """Send one micro-batch to several writers, computing it once (cached for the batch)."""

    def write(batch_df: DataFrame, batch_id: int) -> None:
        if len(writers) == 1:
            writers[0](batch_df, batch_id)
            return
        batch_df.persist()
        try:
            for w in writers:
                w(batch_df, batch_id)
        finally:
            batch_df.unpersist()

    return write
