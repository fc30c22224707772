"""Session defaults the library relies on."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# nanosecond Parquet timestamps of raw grids are read as epoch-ns bigints
NANOS_AS_LONG = {"spark.sql.legacy.parquet.nanosAsLong": "true"}

# Settings every job needs: UTC calendar parts, adaptive execution (partition
# coalescing, skew-join splitting, runtime broadcast), no web UI.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    **NANOS_AS_LONG,
    # checkpoint files of intermediate frames (e.g. Q2's per-cell table) are removed once
    # the frame is garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app_name: str = "soarcast", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder. Only a local session without one
    gets a new folder under the machine's temp folder."""
    context = spark.sparkContext
    if not spark.conf.get("spark.checkpoint.dir", None) and not context.getCheckpointDir() and context.master.startswith("local["):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a fresh scratch folder and read from there: what stands above reads it any
    number of times without its work being done again, and its size decides how it is joined."""
    path = f"{scratch_folder(df.sparkSession, name)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("spark.checkpoint.dir is not set; point it at shared storage")
    return root.rstrip("/")


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]):
    """Set session settings for a block and put back what was there before."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def utc_session(spark: SparkSession):
    """A block in which calendar parts are UTC and nanosecond timestamps can be read."""
    return session_settings(spark, {"spark.sql.session.timeZone": "UTC", **NANOS_AS_LONG})


def ensure_utc(spark: SparkSession) -> None:
    """Calendar parts (hour, month ...) follow the session zone; the marts are UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
