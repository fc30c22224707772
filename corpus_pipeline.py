"""Corpus pipeline: documents in, packed training sequences out.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``. All but the last return the columns of
``documents``; the last returns one row per piece of a packed sequence. Each stage sees all
rows that the one before it kept; what it decides takes effect at once.

Defined results: null and empty texts go through (one of them stays after exact deduplication, and
leaves when the mix takes none of its words); null and repeated ids stay rows of their own; equal
texts and near copies keep the row their operator names; extra columns, whatever their names, pass to
the last stage but one; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from soarcast.llm import exact_dedup, mixing, ngram_join, packing, toxicity
from soarcast.llm.scratch import Scratch

#: the toxicity model and the tokenizer are not expressible in SQL; tests/llm holds the brute-force version
ORACLE_SQL = None


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score as toxic is below one half."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.accept(docs, labels, Scratch(spark, "stage-toxicity"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, white space aside."""
    return exact_dedup.keep_first(docs, exact_dedup.deduplicate_alone(docs, Scratch(spark, "stage-exact-dedup")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates (five words, similarity 0.8 or more)."""
    return ngram_join.one_of_each(docs, Scratch(spark, "stage-ngram-join"), 5, 80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, cut where its runs of blocks begin and end."""
    return mixing.take(docs, Scratch(spark, "stage-mixing"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens."""
    return packing.pack(docs, Scratch(spark, "stage-packing"))


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
