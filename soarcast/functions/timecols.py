"""Time normalisation shared by the grid transform and the live events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    TimestampNTZType,
    TimestampType,
)


def normalize_time(df: DataFrame, col: str = "time") -> DataFrame:
    """Make ``col`` a ``timestamp`` whatever its stored type.

    * bigint  -> epoch nanoseconds (how decoded grids land in Parquet)
    * int, double -> epoch seconds
    * timestamp_ntz -> wall clock read in the session time zone; date -> its midnight
    * string  -> ISO text; malformed text gives NULL instead of failing the query
    * timestamp -> unchanged
    """
    dtype = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dtype, TimestampType):
        return df
    if isinstance(dtype, LongType):
        expr = F.timestamp_micros(F.expr(f"`{col}` div 1000"))
    elif isinstance(dtype, IntegerType):
        expr = F.timestamp_seconds(c)
    elif isinstance(dtype, (DoubleType, FloatType)):
        expr = F.timestamp_micros((c * 1_000_000).cast("long"))
    elif isinstance(dtype, (TimestampNTZType, DateType)):
        expr = c.cast("timestamp")
    elif isinstance(dtype, StringType):
        expr = F.try_to_timestamp(c)
    else:
        raise TypeError(f"cannot read {col} of type {dtype.simpleString()} as a time")
    return df.withColumn(col, expr)


def iso_text(ts: Column) -> Column:
    """ISO-8601 text with microseconds and no zone, e.g. ``2024-01-01T00:00:07.179575``."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
