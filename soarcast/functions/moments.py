"""Moments of a measure that merge: count, mean and sums of squared deviations.

``moments`` and ``pair_moments`` are taken by an ordinary aggregation; ``merged`` and
``merged_pairs`` combine those of disjoint groups by the pairwise formula, which adds the spread
between the groups' means to the spread within them. No large sums cancel, so the result is as
stable as one pass over all rows. A NULL measure takes no part; a NaN makes mean and spread NaN.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MOMENTS = "struct<n: bigint, mean: double, m2: double>"
_PAIRS = "struct<n: bigint, mean_x: double, mean_y: double, m2_x: double, m2_y: double, c: double>"


def moments(col: str) -> Column:
    """Aggregate: ``n``, ``mean`` and ``m2`` (sum of squared deviations) of a measure."""
    n, zero = F.count(col), F.lit(0.0)
    return F.struct(n.alias("n"), F.coalesce(F.avg(col), zero).alias("mean"), F.coalesce(F.var_pop(col) * n, zero).alias("m2"))


def pair_moments(x: str, y: str) -> Column:
    """Aggregate: moments of both measures, and their co-moment ``c``, over rows that have both."""
    zero, a, b = F.lit(0.0), F.when(F.col(y).isNotNull(), F.col(x)), F.when(F.col(x).isNotNull(), F.col(y))
    n = F.count(a)
    return F.struct(
        n.alias("n"), F.coalesce(F.avg(a), zero).alias("mean_x"), F.coalesce(F.avg(b), zero).alias("mean_y"),
        F.coalesce(F.var_pop(a) * n, zero).alias("m2_x"), F.coalesce(F.var_pop(b) * n, zero).alias("m2_y"),
        F.coalesce(F.covar_pop(a, b) * n, zero).alias("c"))


def _or_other(a: Column, b: Column, both: Column) -> Column:
    return F.when(b["n"] == 0, a).when(a["n"] == 0, b).otherwise(both)


def _merge(a: Column, b: Column) -> Column:
    n = a["n"] + b["n"]
    share, d = b["n"] / n, b["mean"] - a["mean"]
    return _or_other(a, b, F.struct(
        n.alias("n"), (a["mean"] + d * share).alias("mean"), (a["m2"] + b["m2"] + d * d * a["n"] * share).alias("m2")))


def _merge_pairs(a: Column, b: Column) -> Column:
    n = a["n"] + b["n"]
    share, dx, dy = b["n"] / n, b["mean_x"] - a["mean_x"], b["mean_y"] - a["mean_y"]
    weight = a["n"] * share
    return _or_other(a, b, F.struct(
        n.alias("n"), (a["mean_x"] + dx * share).alias("mean_x"), (a["mean_y"] + dy * share).alias("mean_y"),
        (a["m2_x"] + b["m2_x"] + dx * dx * weight).alias("m2_x"), (a["m2_y"] + b["m2_y"] + dy * dy * weight).alias("m2_y"),
        (a["c"] + b["c"] + dx * dy * weight).alias("c")))


def _merged(col: str, order: str, kind: str, merge) -> Column:
    groups = F.transform(F.sort_array(F.collect_list(F.struct(order, col))), lambda g: g[col].cast(kind))
    zeros = ", ".join("0" if field.endswith("bigint") else "0D" for field in kind.split(", "))
    return F.aggregate(groups, F.expr(f"cast(struct({zeros}) AS {kind})"), merge)


def merged(col: str, order: str) -> Column:
    """Aggregate: the moments in ``col`` of all groups as one, merged in the order of ``order``.

    The groups of one key meet in one array: use it where their number is bounded (years).
    """
    return _merged(col, order, _MOMENTS, _merge)


def merged_pairs(col: str, order: str) -> Column:
    """Aggregate: as ``merged``, for pair moments."""
    return _merged(col, order, _PAIRS, _merge_pairs)


def mean_of(m: Column) -> Column:
    return F.when(m["n"] > 0, m["mean"])


def stddev_of(m: Column) -> Column:
    """Sample standard deviation; NULL for fewer than two values."""
    return F.when(m["n"] > 1, F.sqrt(m["m2"] / (m["n"] - 1)))


def corr_of(m: Column) -> Column:
    """Pearson correlation of pair moments; NULL for a constant side, as ``safe_corr``."""
    spread = F.sqrt(m["m2_x"] * m["m2_y"])
    return F.try_divide(m["c"], F.when(spread > 0, spread))
