"""Window operators.

``change_from_previous``, ``running_total`` and ``centred_mean`` order a whole frame and
are meant for the small mart frames (one row per month, hour, year or season-hour),
whose size is fixed by the calendar, not by the data. ``global_rank`` ranks a frame
whose size grows with the data (e.g. one row per grid cell) without funnelling it
through one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.numeric import stable_round


def _order(col: str, ascending: bool, nulls_last: bool) -> Column:
    c = F.col(col)
    if ascending:
        return c.asc_nulls_last() if nulls_last else c.asc_nulls_first()
    return c.desc_nulls_last() if nulls_last else c.desc_nulls_first()


def small_rank(df: DataFrame, col: str, ascending: bool = False, partition_by=(), nulls_last: bool = True,
               alias: str = "rank") -> DataFrame:
    """``rank()`` over a calendar-sized frame (months, hours, seasons)."""
    w = Window.partitionBy(*partition_by).orderBy(_order(col, ascending, nulls_last))
    return df.withColumn(alias, F.rank().over(w))


def change_from_previous(df: DataFrame, col: str, order: str, scale: int, alias: str,
                         partition_by=()) -> DataFrame:
    """``round(col - lag(col), scale)`` along ``order``; first row gets NULL."""
    w = Window.partitionBy(*partition_by).orderBy(F.col(order).asc_nulls_first())
    return df.withColumn(alias, stable_round(F.col(col) - F.lag(col, 1).over(w), scale))


def running_total(df: DataFrame, col: str, order: str, scale: int, alias: str) -> DataFrame:
    """Rounded cumulative sum, ``ROWS UNBOUNDED PRECEDING .. CURRENT ROW``."""
    w = Window.orderBy(F.col(order).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(alias, stable_round(F.sum(col).over(w), scale))


def centred_mean(df: DataFrame, col: str, order: str, scale: int, alias: str, partition_by=()) -> DataFrame:
    """Rounded mean of the row and its two neighbours (``ROWS 1 PRECEDING .. 1 FOLLOWING``)."""
    w = Window.partitionBy(*partition_by).orderBy(F.col(order).asc_nulls_first()).rowsBetween(-1, 1)
    return df.withColumn(alias, stable_round(F.avg(col).over(w), scale))


def global_rank(df: DataFrame, col: str, ascending: bool = True, nulls_last: bool = True,
                alias: str = "rank", buckets: int | None = None, accuracy: int | None = None,
                result_type: str = "int") -> DataFrame:
    """``rank() OVER (ORDER BY col)`` for a frame of any size, computed in parallel.

    1. Ties are collapsed first: one row per distinct value with its multiplicity, so
       a value shared by a third of all rows is one row from here on.
    2. Approximate quantiles of the distinct values (a bounded array from one scalar
       subquery) split the value line into ``buckets`` contiguous ranges. The bucket is
       a pure function of the value, so every value lands in exactly one bucket and the
       result is exact whatever the quantile error. The bucket is found with a two-level
       search (every sqrt(B)-th bound, then one slice), ~2*sqrt(B) comparisons per value.
    3. Rows before each bucket: a prefix sum over at most ``buckets + 1`` rows,
       broadcast back (bounded by ``buckets``).
    4. Rows before each value inside its bucket: a running sum per bucket.
    5. The rank is joined back to the rows on the value (NULL-safe). A hot value is
       one row on the small side, so AQE's skew-join split covers the big side.

    ``result_type="bigint"`` is for ranks of rows, which may pass 2^31; the default ``int``
    suits ranks of grid cells. ``accuracy`` of the quantiles defaults to 20 per bucket, so the
    sketches that meet in one task stay a small multiple of the bucket count.

    ``col`` must be numeric. Ties share a rank and leave gaps, as ``rank()``. NULLs go
    first or last as asked, and NaN sorts above every number, as in Spark's ordering.
    """
    if not isinstance(df.schema[col].dataType, NumericType):
        raise TypeError(f"global_rank needs a numeric column; {col} is {df.schema[col].dataType.simpleString()}")
    spark = df.sparkSession
    if buckets is None:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(int(buckets), 1)
    accuracy = accuracy or max(1000, 20 * buckets)

    value = F.col(col)
    # bucketing runs on an ascending key: the value, or its negation for DESC
    key = value.cast("double") if ascending else -value.cast("double")
    is_nan = F.isnan(value.cast("double"))
    values = df.groupBy(col).agg(F.count(F.lit(1)).alias("_n"))

    fractions = [i / buckets for i in range(1, buckets)]
    if fractions:
        step = max(1, math.isqrt(len(fractions)))
        bounds = (
            # the row count keeps this subquery's shuffle equal to the one below, so both read one scan
            values.select(F.percentile_approx(F.when(~is_nan, key), fractions, accuracy).alias("b"), F.sum("_n").alias("n"))
            .select(F.struct(
                "n",
                F.coalesce("b", F.array().cast("array<double>")).alias("fine"),
                F.coalesce(F.filter("b", lambda x, i: (i + 1) % step == 0),
                           F.array().cast("array<double>")).alias("coarse"),
            ).alias("s"))
            .scalar()
        )
        # attached as a column first: a subquery may not sit inside a lambda's arguments
        values = values.withColumn("_bounds", bounds)
        block = F.size(F.filter("_bounds.coarse", lambda x: x < key))
        in_block = F.slice("_bounds.fine", block * step + 1, step)
        before = block * step + F.size(F.filter(in_block, lambda x: x < key))
    else:
        values = values.withColumn("_bounds", F.lit(None))
        before = F.lit(0)
    # NaN sorts above every number (last ascending, first descending); NULLs go to an end
    nan_bucket = F.lit(buckets if ascending else -1)
    null_bucket = F.lit(buckets + 1 if nulls_last else -2)
    # by bucket: the sizes (one row per bucket) and the running sum read the same shuffle, which
    # therefore must keep the same columns and filters on both sides (hence the outer join below:
    # an inner one would filter NULL buckets, which do not occur, on one side)
    bucketed = (
        values.withColumn(
            "_bucket", F.when(value.isNull(), null_bucket).when(is_nan, nan_bucket).otherwise(before)
        )
        .drop("_bounds")
        .repartition("_bucket")
    )

    sizes = bucketed.groupBy("_bucket").agg(F.sum("_n").alias("_size"), F.max(value).alias("_last"))
    offsets = sizes.withColumn(
        "_offset",
        F.coalesce(
            F.sum("_size").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ),
    ).select(F.col("_bucket").alias("_of"), "_offset", "_last")

    in_bucket = Window.partitionBy("_bucket").orderBy(_order(col, ascending, nulls_last)).rowsBetween(
        Window.unboundedPreceding, -1
    )
    ranked = (
        bucketed.withColumn("_before", F.coalesce(F.sum("_n").over(in_bucket), F.lit(0)))
        .join(F.broadcast(offsets), (F.col("_bucket") == F.col("_of")) & (value.isNull() | (value <= F.col("_last"))), "left")
        .select(value.alias("_value"), (F.col("_offset") + F.col("_before") + 1).cast(result_type).alias(alias))
    )
    out = df.join(ranked, df[col].eqNullSafe(ranked["_value"]), "left")
    return out.drop("_value")
