"""Aggregates that the marts share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ratio


def distinct_count(df: DataFrame, *cols: str) -> Column:
    """Number of distinct ``cols`` combinations, NULL combinations included, as a
    lazy scalar (an uncorrelated scalar subquery run once per query).

    This is the count of ``df.select(*cols).distinct()``. It stays on the cluster:
    partial distinct per task, one shuffle on the key, then a one-row count. No
    driver round trip and no join are needed to use it in a later expression.
    """
    return df.select(F.count_distinct(F.struct(*cols)).alias("n")).scalar()


def per_unit(count: Column, *denominators: Column) -> Column:
    """``count / d1 / d2 ...`` as double (NULL when a denominator is 0)."""
    out = count
    for d in denominators:
        out = ratio(out, d)
    return out


#: log2 of a sketch's buckets; the standard error of its estimate is 1.04 / sqrt(2**14), below 0.9 percent
SKETCH_BITS = 14


def distinct_key(*cols: str) -> Column:
    """A combination of columns as one bigint: a hash that tells NULLs from values and from each other.

    ``-0.0`` counts as ``0.0``. Distinct combinations share a hash with odds of about n^2 / 2^64.
    """
    parts = []
    for c in cols:
        parts += [F.col(c).isNull(), F.col(c)]
    return F.xxhash64(*parts)


def distinct_sketch(*cols: str, bits: int = SKETCH_BITS) -> Column:
    """Aggregate: a mergeable sketch (HyperLogLog) of the distinct combinations of ``cols``, NULLs included.

    It is a few KB whatever the number of rows, so nothing but sketches is shuffled; stored by
    group, sketches merge later (``merged_count``).
    """
    return F.hll_sketch_agg(distinct_key(*cols), bits)


def merged_count(sketch: str) -> Column:
    """Aggregate: estimated number of distinct combinations in all the sketches of a column."""
    return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(sketch)), F.lit(0)).cast("bigint")


def approx_distinct_count(df: DataFrame, *cols: str, bits: int = SKETCH_BITS) -> Column:
    """``distinct_count`` by a sketch: one pass without a shuffle of keys, as a lazy scalar."""
    return df.select(F.coalesce(F.hll_sketch_estimate(distinct_sketch(*cols, bits=bits)), F.lit(0)).cast("bigint").alias("n")).scalar()
