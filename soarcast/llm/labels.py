"""Labelled rows for the classifiers, and what keeps fold 0 out of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: folds are crc32 of the id (as text) modulo 5: fold 0 is held out, fold 4 calibrates, the rest train
CALIBRATION_FOLD = 4
#: other splits by two bits of a hash each, tried where no fold splits both classes
HASH_SPLITS = 16


def fold(doc_id: str = "doc_id") -> Column:
    """The fold of a row; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(5)).cast("int")


def labelled(labels: DataFrame, column: str) -> DataFrame:
    """``doc_id, y, fold`` of the labelled ids outside fold 0.

    Null ids and null labels are left out; of contradicting labels of one id the larger counts.
    """
    known = labels.filter(F.col(column).isNotNull() & F.col("doc_id").isNotNull())
    return known.groupBy("doc_id").agg(F.max(column).cast("int").alias("y")).withColumn("fold", fold()).filter("fold > 0")


def calibration_part(target: DataFrame) -> Column:
    """Which rows of ``labelled`` calibrate: those of fold 4, if it and the rest hold both classes.

    Otherwise folds 3 to 1 are tried, then splits of all four folds by a hash of the id. With a
    class of a single id no split holds it twice, and fold 4 it is. One aggregate over the labels.
    """
    in_fold = [F.col("fold") == f for f in range(CALIBRATION_FOLD, 0, -1)]
    bits = F.xxhash64(F.col("doc_id").cast("string"))
    ways = [*in_fold, *[F.shiftright(bits, 2 * i).bitwiseAND(F.lit(3)) == 0 for i in range(HASH_SPLITS)]]
    one = F.col("y") == 1
    least = lambda way: F.least(*[F.count_if(side & y) for side in (way, ~way) for y in (one, ~one)])
    found = target.agg(*[least(way).alias(f"n{i}") for i, way in enumerate(ways)]).first()
    return next((way for way, n in zip(ways, found) if n), ways[0])


def sample(docs: DataFrame, labels: DataFrame, column: str, n_train: int, n_calibrate: int) -> DataFrame:
    """``doc_id, text, y, calibrate`` of the labelled ids outside fold 0 with the least hashes.

    At most ``n_train`` training and ``n_calibrate`` calibration rows, one for each id: where rows
    repeat an id, its least text (null if it has no other).
    """
    target = labelled(labels, column)
    picked = target.withColumn("calibrate", calibration_part(target))
    by_hash = lambda df, n: df.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    picked = by_hash(picked.filter("NOT calibrate"), n_train).unionByName(by_hash(picked.filter("calibrate"), n_calibrate))
    # at most n_train + n_calibrate rows of a few bytes: safe to broadcast, so only texts of these ids are shuffled
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    return rows.groupBy("doc_id", "y", "calibrate").agg(F.min("text").alias("text")).select("doc_id", "text", "y", "calibrate")
