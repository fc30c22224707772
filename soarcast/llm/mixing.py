"""Mixing sources to target weights (native: DataFrame operations only).

Sources share ``budget`` times the corpus's words by weight; a target stops at ``repeat``
times its source's words and the excess is reshared by weight. The documents of a source
are dealt to shards by a seeded hash, put in seeded order within a shard, and their words
cut into blocks of equal size. Sainte-Lague (highest quotients votes / (2 seats + 1))
apportions blocks to sources, to groups of shards of a source and to the shards of a group. A shard takes every
block ``quota div blocks`` times and a seeded run of ``quota mod blocks`` blocks once more;
since the order is seeded, a run is a random choice, and it cuts at most two documents.

Only per-source and per-shard totals are compared with each other; documents need one
shuffle by shard. A shard holds about ``SHARD_WORDS`` words at every size, so a source that holds
a third of all rows is spread over many tasks. Documents are dealt by id and text, and rows that
are alike in both in turn, so neither a null nor a repeated id fills a shard. Quotients are made only for the seats that are still
open: every seat that the bound ``votes / (seats - n / 2)`` proves is given at once, which
leaves about four rows per party, whatever the size of the corpus.

Defined results: a null source is a source of its own, after all others; null and empty
texts have size 0 and nothing is taken of them; a null id sorts as an empty one; repeated
rows are rows of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import Scratch, free_names

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: share of all words that the mix takes, in hundredths, and most repeats of a source
BUDGET_PERCENT, REPEAT = 150, 2
#: a block has at most BLOCK_WORDS words, and a source's target at least BLOCKS_PER_TARGET blocks
BLOCK_WORDS, BLOCKS_PER_TARGET = 1024, 200
#: words (and documents) of a shard, and shards of a source that are apportioned together
SHARD_WORDS, GROUP_SHARDS = 1 << 18, 4096
SEED = "mix-1"


def _hash(*parts: Column | str) -> Column:
    """Sixty bits of the MD5 of the parts, joined by colons."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sources: DataFrame) -> DataFrame:
    """Add ``weight`` and ``target`` to one row per source with its ``source_size``.

    With sources in order of size per weight, a source is capped when its cap is below its
    share of what the sources before it leave; integers up to the last division.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    n = len(WEIGHTS)
    pick = (F.row_number().over(by_name) - 1) % n
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (pick + 1).cast("int"))
    weighed = sources.withColumn("weight", weight.cast("bigint"))
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    d = weighed.withColumns({
        "_all": F.sum("source_size").over(everything),
        "_w": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        "_done": F.coalesce(F.sum("source_size").over(before), F.lit(0)),
    })
    # what is left of the budget for this source and those after it, in hundredths of a word
    left = F.lit(BUDGET_PERCENT) * F.col("_all") - F.lit(100 * REPEAT) * F.col("_done")
    wide = lambda c: c.cast("decimal(38,0)")
    capped = wide(F.lit(100 * REPEAT) * F.col("source_size")) * wide(F.col("_w")) < wide(F.col("weight")) * wide(left)
    d = d.withColumns({"_left": left, "_capped": capped})
    first_free = F.min(F.when(~F.col("_capped"), F.struct(F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source"), F.col("_left"), F.col("_w"))))
    free = first_free.over(everything)
    d = d.withColumn("_free", free)
    share = (F.col("weight") * F.col("_free._left")).cast("double") / (F.lit(100) * F.col("_free._w")).cast("double")
    target = F.when(F.col("_capped"), (F.lit(REPEAT) * F.col("source_size")).cast("double")).otherwise(share)
    return d.select(*sources.columns, "weight", target.alias("target"))


def sainte_lague(parties: DataFrame, key: list[str], group: list[str]) -> DataFrame:
    """Seats by highest quotients ``votes / (2 k + 1)``, ties to the smaller key.

    ``parties`` has ``key`` columns (without nulls), ``votes``, and ``seats`` and ``limit``:
    the seats of its group, and the most seats that this party can fill. Returns the key
    columns and ``won``.
    """
    whole = Window.partitionBy(*group)
    d = parties.withColumns({"_v": F.sum("votes").over(whole), "_n": F.count(F.lit(1)).over(whole)})
    share = lambda seats: F.col("votes") * seats / F.when(F.col("_v") > 0, F.col("_v"))
    sure = F.floor(share(F.greatest(F.col("seats") - F.col("_n") / 2, F.lit(0.0))) - 0.5)
    most = F.ceil(share(F.col("seats") + F.col("_n") / 2) + 0.5)
    # one seat of slack either way keeps rounding of the quotients themselves out of the proof
    d = d.withColumns({
        "_sure": F.greatest(F.coalesce(sure, F.lit(0)) - 1, F.lit(0)).cast("bigint"),
        "_most": (F.coalesce(most, F.lit(0)) + 1).cast("bigint"),
    })
    d = d.withColumn("_open", F.col("seats") - F.sum("_sure").over(whole))
    quotients = d.filter("votes > 0").withColumn("_k", F.explode(F.sequence("_sure", "_most")))
    order = Window.partitionBy(*group).orderBy(F.desc(F.col("votes") / (2 * F.col("_k") + 1)), *key)
    won = quotients.withColumn("_rank", F.row_number().over(order)).filter("_rank <= _open")
    extra = won.groupBy(*key).agg(F.count(F.lit(1)).alias("_extra"))
    return d.join(extra, key, "left").select(
        *key, F.least("limit", F.col("_sure") + F.coalesce("_extra", F.lit(0))).alias("won"))


def mix(docs: DataFrame, scratch: Scratch, seed: str = SEED) -> DataFrame:
    """What the mix takes of every document.

    Returns one row per document: ``doc_id, source, size, source_size, target, copies`` (whole
    times it is taken), ``cut`` (up to two word ranges ``[first, last)`` taken once more) and
    ``taken`` (words taken in all).
    """
    # equal rows become one with their number, before and after the shuffle
    rows = docs.select("doc_id", "source", word_count().alias("size"), F.xxhash64("text").alias("text_hash"))
    rows = scratch.table(rows.groupBy("doc_id", "source", "size", "text_hash").agg(F.count(F.lit(1)).alias("n")), "sizes")
    sources = scratch.table(targets(rows.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("source_rows"))), "sources")
    sources = sources.withColumns({
        "sid": F.concat_ws("", F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.lit("0")), F.col("source")),
        "shards": F.ceil((F.col("source_size") + F.col("source_rows")) / SHARD_WORDS).cast("bigint"),
    })
    smallest = sources.filter("target > 0").agg(
        F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.floor(F.min("target") / BLOCKS_PER_TARGET))).cast("bigint")).scalar()

    sid = F.concat_ws("", F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.lit("0")), F.col("source"))
    by_source = sources.select("sid", "source_size", "target", "shards")
    dealt = rows.withColumn("sid", sid).join(by_source, "sid").withColumn(
        "first_shard", F.pmod(_hash(F.lit(seed), F.col("doc_id"), F.col("text_hash")), F.col("shards")))
    # n equal rows go to the shards after the first one in turn; here is how many each gets
    turn = F.explode(F.sequence(F.lit(0).cast("bigint"), F.least("n", "shards") - 1))
    dealt = dealt.withColumn("turn", turn).withColumns({
        "shard": F.pmod(F.col("first_shard") + F.col("turn"), F.col("shards")),
        "n": F.ceil((F.col("n") - F.col("turn")) / F.col("shards")).cast("bigint")})

    cells = dealt.groupBy("sid", "shard").agg(F.sum(F.col("size") * F.col("n")).alias("words"), F.first("source_size").alias("source_size"), F.first("target").alias("target"))
    cells = scratch.table(cells.withColumn("blocks", F.ceil(F.col("words") / smallest).cast("bigint")), "cells")
    per_source = cells.groupBy("sid").agg(F.sum("blocks").alias("blocks"), F.first("source_size").alias("source_size"), F.first("target").alias("target"))
    wanted = F.when(F.col("source_size") > 0, F.col("target") * F.col("blocks") / F.col("source_size")).otherwise(F.lit(0.0))
    per_source = per_source.withColumn("votes", wanted).withColumn("limit", REPEAT * F.col("blocks"))
    per_source = scratch.table(per_source, "votes")
    seats = per_source.agg(F.floor(F.sum(F.col("votes").cast("decimal(38,6)")) + F.lit(0.5)).cast("bigint")).scalar()
    quotas = sainte_lague(per_source.withColumns({"seats": seats, "all": F.lit(0)}), ["sid"], ["all"])
    # a group has at most GROUP_SHARDS shards, so no window grows with its source's words
    cells = cells.withColumn("part", F.floor(F.col("shard") / GROUP_SHARDS).cast("bigint"))
    parties = lambda df, won: df.join(won.withColumnRenamed("won", "seats"), [c for c in won.columns if c != "won"]).withColumns(
        {"votes": F.col("blocks").cast("double"), "limit": REPEAT * F.col("blocks")})
    parts = scratch.table(parties(cells.groupBy("sid", "part").agg(F.sum("blocks").alias("blocks")), quotas), "parts")
    part_quotas = sainte_lague(parts, ["sid", "part"], ["sid"])
    shards = scratch.table(parties(cells.select("sid", "part", "shard", "words", "blocks"), part_quotas), "parties")
    plan = shards.join(sainte_lague(shards, ["sid", "part", "shard"], ["sid", "part"]), ["sid", "part", "shard"])
    # the seeded run of extra blocks, as one or two ranges of the shard's words
    edge = lambda j: F.floor(j * F.col("words") / F.greatest("blocks", F.lit(1))).cast("bigint")
    blocks = F.greatest("blocks", F.lit(1))
    first = F.pmod(_hash(F.lit(seed), F.col("sid"), F.col("shard")), blocks)
    extra = F.pmod(F.col("won"), blocks)
    last = first + extra
    plan = scratch.table(plan.select(
        "sid", "shard", F.floor(F.col("won") / blocks).cast("bigint").alias("copies"),
        edge(first).alias("a0"), edge(F.least(last, blocks)).alias("a1"), edge(F.greatest(last - blocks, F.lit(0))).alias("b1")), "plan")

    in_order = Window.partitionBy("sid", "shard").orderBy(
        _hash(F.lit(seed), F.lit("order"), F.col("doc_id"), F.col("text_hash")), "doc_id", "text_hash", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # equal rows of a shard lie side by side; each gets its own place
    placed = dealt.join(plan, ["sid", "shard"]).withColumn("behind", F.sum(F.col("size") * F.col("n")).over(in_order))
    placed = placed.withColumn("place", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n")))).withColumn(
        "end", F.col("behind") - (F.col("n") - F.col("place")) * F.col("size")).withColumn("begin", F.col("end") - F.col("size"))
    part = lambda lo, hi: F.struct(
        (F.least(F.greatest(lo, F.col("begin")), F.col("end")) - F.col("begin")).alias("first"),
        (F.least(F.greatest(hi, F.col("begin")), F.col("end")) - F.col("begin")).alias("last"))
    # in the order of the words: the wrapped range first
    ranges = F.array(part(F.lit(0).cast("bigint"), F.col("b1")), part(F.col("a0"), F.col("a1")))
    placed = placed.withColumn("cut", F.filter(ranges, lambda r: r["last"] > r["first"]))
    more = F.aggregate("cut", F.lit(0).cast("bigint"), lambda acc, r: acc + r["last"] - r["first"])
    return placed.select("doc_id", "source", "size", "source_size", "target", "copies", "cut",
                         (F.col("copies") * F.col("size") + more).alias("taken"))


def take(docs: DataFrame, scratch: Scratch, seed: str = SEED) -> DataFrame:
    """The mix itself: the rows of ``docs``, once for every whole time they are taken, and cut
    to the words of a run that begins or ends within them. Documents of which nothing is taken
    leave. Columns stay as they are, except that ``n_chars`` follows a cut text."""
    columns = docs.columns
    key, text_key, copies_name, cuts_name, part_name = free_names(columns, "_id", "_text_hash", "_copies", "_cuts", "_part")
    identity = F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text"))
    decided = mix(docs.select(identity.alias("doc_id"), "source", "text"), scratch, seed).filter("taken > 0")
    whole = F.filter("cut", lambda r: (r["first"] == 0) & (r["last"] == F.col("size")))
    cut = F.filter("cut", lambda r: ~((r["first"] == 0) & (r["last"] == F.col("size"))))
    # rows that repeat with id and text alike are taken together
    decided = decided.groupBy(F.col("doc_id.id").alias(key), F.col("doc_id.text").alias(text_key)).agg(
        F.sum(F.col("copies") + F.size(whole)).cast("int").alias(copies_name), F.flatten(F.collect_list(cut)).alias(cuts_name))
    marked = docs.withColumn(text_key, F.xxhash64("text"))
    joined = marked.join(decided, marked["doc_id"].eqNullSafe(decided[key]) & (marked[text_key] == decided[text_key]))
    joined = joined.drop(marked[text_key])
    joined = joined.dropDuplicates([key, text_key])
    pieces = F.concat(F.array_repeat(F.lit(None).cast("struct<first:bigint,last:bigint>"), F.col(copies_name)), F.col(cuts_name))
    parts = joined.withColumn(part_name, F.explode(pieces))
    spaced = F.regexp_extract_all(F.col("text"), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    some = F.slice(spaced, (F.col(f"{part_name}.first") + 1).cast("int"), (F.col(f"{part_name}.last") - F.col(f"{part_name}.first")).cast("int"))
    text = F.when(F.col(part_name).isNull(), F.col("text")).otherwise(F.regexp_replace(F.array_join(some, ""), r"^[\x20\x09-\x0D]+", ""))
    out = parts.withColumn("text", text)
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col(part_name).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return out.select(*[F.col(f"`{c}`") for c in columns])


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mix(docs, Scratch(spark, "mixing")).select("doc_id", "size", "source_size", "target", "taken")
