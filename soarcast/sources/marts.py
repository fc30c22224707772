"""Curated marts: Parquet on shared storage and export to a relational database."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from .publish import Published

# Marts copied to the database and their table names (q2 and q8 stay on storage only).
EXPORTED_MARTS = {
    "q1_flying_hours_by_month": "batch_q1",
    "q3_hourly_conditions": "batch_q3",
    "q4_hourly_by_category": "batch_q4",
    "q5_cape_cloudbase_correlation": "batch_q5",
    "q6_dangerous_conditions": "batch_q6",
    "q7_xc_best_months": "batch_q7",
    "q9_blh_development": "batch_q9",
    "q10_climate_trend": "batch_q10",
}


def mart_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def write_mart(df: DataFrame, root: str, name: str, one_file: bool = False) -> str:
    """Publish one mart, by as many tasks as the mart's last stage has; returns the folder of this version.

    ``one_file`` is for marts whose size the calendar bounds (``plans.CALENDAR_MARTS``): their
    last stage is a single ordered partition already, so one file costs nothing. Readers of the
    mart (``read_mart``) see the version before until this one is committed.
    """
    table = Published(df.sparkSession, mart_path(root, name))
    table.replace_all(df.coalesce(1) if one_file else df)
    return table.folder()


def read_mart(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The committed version of a mart."""
    return Published(spark, mart_path(root, name)).read()


def export_marts(
    spark: SparkSession,
    root: str,
    url: str,
    properties: Mapping[str, str],
    mapping: Mapping[str, str] = EXPORTED_MARTS,
) -> dict[str, int]:
    """Copy marts to database tables (overwrite); returns rows written per table.

    The row count is taken by an ``observe`` metric on the same write job, so each
    mart is read once.
    """
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    written = {}
    for name, table in mapping.items():
        obs = Observation(f"export_{table}")
        df = read_mart(spark, root, name).observe(obs, F.count(F.lit(1)).alias("rows"))
        df.write.jdbc(url=url, table=table, mode="overwrite", properties=dict(properties))
        written[table] = int(obs.get["rows"])
    return written
