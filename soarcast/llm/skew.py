"""Joins of rows to one row per group, safe when one group holds a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

#: A group is hot when it has more than this share of all rows, so there are at most 1000.
HOT_SHARE = 1000
#: cells to which the ids of a sieve are hashed: at most so many small rows are broadcast
SIEVE_CELLS = 1 << 20


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str, how: str = "inner") -> DataFrame:
    """Join ``rows`` to ``groups`` (unique ``key``, row count of the group in ``size``).

    Groups of more than 1/1000 of all rows cannot number more than 1000, so they are
    broadcast whatever the size of the input; all other groups go through a shuffled join,
    where no key has more than a thousandth of the rows. A null key joins nothing.
    """
    total = groups.agg(F.sum(size).alias("_total")).scalar()
    marked = groups.withColumn("_hot", F.col(size) * HOT_SHARE > total)
    hot = marked.filter("_hot").drop("_hot")
    cold = marked.filter("NOT _hot").drop("_hot")
    hot_keys = hot.select(key)
    hot_rows = rows.join(F.broadcast(hot_keys), key, "left_semi")
    cold_rows = rows.join(F.broadcast(hot_keys), key, "left_anti")
    return hot_rows.join(F.broadcast(hot), key, "inner").unionByName(cold_rows.join(cold, key, how))


def sieve(docs: DataFrame, ids: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows of ``docs`` whose ``doc_id`` may be one of ``ids``, before a join shuffles them.

    Ids are hashed to ``SIEVE_CELLS`` cells and the cells in use broadcast, so the broadcast is
    bounded whatever the input. Rows of other ids that share a cell pass too: the join decides.
    """
    cell = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(SIEVE_CELLS)).cast("int").alias("_cell")
    used = scratch.table(ids.select(cell).distinct(), "sieve")
    return docs.withColumn("_cell", cell).join(F.broadcast(used), "_cell", "left_semi").drop("_cell")
