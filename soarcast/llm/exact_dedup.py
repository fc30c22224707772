"""Exact deduplication against a persistent digest index (native: DataFrame operations only).

Texts are equal when they are identical after every character of ``[ \\t\\n\\v\\f\\r]`` is
deleted; a null text counts as empty. The index is a Parquet table of one row per known
text, bucketed and sorted by the SHA-256 digest of the normalised text. A new batch is
grouped by digest (partial aggregation first, so a text that makes up a third of all rows
arrives as one row per task), compared with the index by a sort-merge anti-join in which
the index side needs no shuffle, and its new digests are appended.

Defined results: null ids sort after all others; of rows repeated with id and text alike
exactly one stays; an empty table gives an empty result; extra columns pass through
:func:`keep_first` untouched and may carry any name.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch, free_names
from .skew import attach

SPACES = " \t\n\x0b\x0c\r"


def normalised(text: str = "text") -> Column:
    """The text without white space; null is empty."""
    return F.translate(F.coalesce(F.col(text), F.lit("")), SPACES, "")


class DigestIndex:
    """Known texts: ``digest`` (32 bytes), ``keep_id``, ``keep_points`` (code points of the kept text).

    ``path`` is the index's folder in shared storage. Beside its files the folder holds a small
    table of generations: folder, number of buckets and type of the ids. So an index is opened with
    the buckets it was written with, whatever the session's settings are, and ids of another type
    are refused. ``buckets`` counts for a new index (default: the shuffle partitions) and for
    ``compact``. The catalog table ``name`` exists only between opening and ``close``.
    """

    def __init__(self, spark: SparkSession, path: str, name: str, id_type: str = "bigint", buckets: int | None = None):
        self.spark, self.path, self.id_type = spark, path.rstrip("/"), id_type
        self.name = f"{name}_{uuid.uuid4().hex[:8]}"
        known = self._generations()
        if known is None:
            self._describe(0, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
            known = self._generations()
        last = known.orderBy(F.desc("generation")).first()
        if last.id_type != id_type:
            raise ValueError(f"the index at {path} holds ids of type {last.id_type}, not {id_type}")
        self.generation, self.buckets = last.generation, last.buckets
        self._open()

    def _generations(self) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.path}/generations")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _describe(self, generation: int, buckets: int) -> None:
        row = self.spark.range(1).select(
            F.lit(generation).alias("generation"), F.lit(buckets).alias("buckets"), F.lit(self.id_type).alias("id_type"))
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/generations")

    def _open(self) -> None:
        self.spark.sql(
            f"CREATE TABLE {self.name} (digest BINARY, keep_id {self.id_type}, keep_points BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}/generation-{self.generation}'")

    def _write(self, rows: DataFrame, name: str, generation: int, buckets: int) -> None:
        columns = rows.select("digest", "keep_id", "keep_points").repartition(buckets, "digest")
        columns.write.mode("append").format("parquet").bucketBy(buckets, "digest").sortBy("digest").option(
            "path", f"{self.path}/generation-{generation}").saveAsTable(name)

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, new: DataFrame) -> None:
        """Add rows whose digests the index does not hold; each task writes whole buckets."""
        self._write(new, self.name, self.generation, self.buckets)
        self.spark.catalog.refreshTable(self.name)

    def compact(self, buckets: int | None = None) -> None:
        """Rewrite the index with one sorted file a bucket (appends add one each), or other buckets.

        The new generation counts once it is written whole; the old one's files stay for open readers.
        """
        buckets, made = buckets or self.buckets, f"{self.name}_new"
        generation = self.generation + 1
        self._write(self.table(), made, generation, buckets)
        self._describe(generation, buckets)
        self.close()
        self.spark.sql(f"DROP TABLE IF EXISTS {made}")
        self.generation, self.buckets = generation, buckets
        self._open()

    def close(self) -> None:
        """Forget the catalog table; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id",
        F.length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_points"),
        F.unhex(F.sha2(normalised().cast("binary"), 256)).alias("digest"),
        # tells rows repeated with id and text alike apart; the rows are written once, so it stays
        F.monotonically_increasing_id().alias("row_no"),
    )


def _groups(rows: DataFrame) -> DataFrame:
    """One row per digest: the row that stays and the number of rows."""
    best = F.min(F.struct(-F.col("n_points"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_no")))
    return rows.groupBy("digest").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size")).select(
        "digest", "group_size", F.col("best.doc_id").alias("keep_id"), (-F.col("best.col1")).alias("keep_points"), F.col("best.row_no").alias("keep_row"))


def deduplicate(docs: DataFrame, index: DigestIndex, scratch: Scratch) -> DataFrame:
    """Decide every row of a batch and add its new texts to the index.

    Returns ``doc_id, keep_id, group_size, kept, digest, n_points``: the row that stays for
    each text (of an earlier batch, if the index knew the text), the batch's rows with that
    text, and whether this row is the one that stays.
    """
    rows = scratch.table(_rows(docs), "rows")
    groups = scratch.table(_groups(rows), "groups")
    new = scratch.table(groups.join(index.table(), "digest", "left_anti"), "new")
    known = index.table().select("digest", F.col("keep_id").alias("index_id"))
    old = scratch.table(groups.join(known, "digest").select("digest", "group_size", F.col("index_id").alias("keep_id")), "old")
    index.append(new)
    # of a known text no row stays
    decided = new.select("digest", "group_size", "keep_id", "keep_row").unionByName(old.withColumn("keep_row", F.lit(None).cast("bigint")))
    kept = F.col("row_no").eqNullSafe(F.col("keep_row"))
    return attach(rows, decided, "digest", "group_size").select(
        "doc_id", "keep_id", "group_size", kept.alias("kept"), "digest", "n_points")


def deduplicate_alone(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``deduplicate`` against a new index that is not kept."""
    index = new_index(docs.sparkSession, scratch, docs.schema["doc_id"].dataType.simpleString())
    try:
        return deduplicate(docs, index, scratch)
    finally:
        index.close()


def keep_first(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    on = free_names(docs.columns, "_digest", "_row_key", "_points")
    keys = decisions.filter("kept").select(
        F.col("digest").alias(on[0]), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias(on[1]), F.col("n_points").alias(on[2]))
    marked = docs.withColumns({
        on[0]: F.unhex(F.sha2(normalised().cast("binary"), 256)),
        on[1]: F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
        on[2]: F.length(F.coalesce("text", F.lit(""))).cast("bigint"),
    })
    # repeated rows share all three, so this needs no further shuffle after the join
    return marked.join(keys, on, "left_semi").dropDuplicates(on).select(*[F.col(f"`{c}`") for c in docs.columns])


def new_index(spark: SparkSession, scratch: Scratch, id_type: str = "bigint") -> DigestIndex:
    """An empty index in the scratch folder of one run."""
    return DigestIndex(spark, scratch.path("index"), f"llm_digest_index_{scratch.run}", id_type)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    decided = deduplicate_alone(docs, Scratch(spark, "exact-dedup"))
    return decided.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), r AS (
  SELECT doc_id, norm, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS rn,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM t WINDOW w AS (PARTITION BY norm ORDER BY length(text) DESC, doc_id NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
)
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, sha256(norm) AS text_sha256 FROM r
"""
