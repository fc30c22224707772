"""Grouped prefix join of documents on the Jaccard similarity of their word n-grams.

1. Every text becomes its set of hashed n-grams; equal sets are one class from here on.
2. n-grams that recur within chunks of documents (lossy counting over all documents) get a
   place at the end of the order; all others are ordered by hash. Any order gives the same
   links; this one keeps passages that many documents share out of the prefixes.
3. Similar sets share an n-gram of their prefixes (n - ceil(t n) + 1 first ones). Sets with
   equal prefix and size are collapsed into one group. A group carries two bitmaps: bits
   that all its members have and bits that any has (long sets a wider one). Groups that meet
   at an n-gram are compared by size and by the bits in which all members must differ, which
   never loses a similar pair. What is left is kept as stars of candidate links, never as all
   pairs.
4. The connected groups are expanded into their members, whose texts are read again and
   verified by exact intersection, skipping pairs that are connected already. Clusters of
   more than ``BLOCK_NGRAMS`` n-grams are cut into blocks and verified block by block.

A list of groups longer than ``POSTING_BLOCK`` is cut the same way, so no task ever holds
an unbounded group. Everything is exact up to collisions of 64-bit hashes.

Defined results: A-Z are lower-cased, words are runs without ``[ \\t\\n\\v\\f\\r]``; a text
with fewer words than the n-gram has its whole sequence as its one member; a null text or
one without words has no set and is linked with nothing; repeated rows are one class; rows
with a null id take the id of their class, if any other row has one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .components import components
from .scratch import Scratch, free_names
from .skew import attach
from .text import IS_SPACE, LOWER, Slice, mix, short_sequences, slices, windows
from .workers import tidy

#: bits of every set's bitmap; sets of more than WIDE_FROM n-grams have a second one of WIDE_BITS
BITS, WIDE_BITS, WIDE_FROM = 512, 2048, 512
#: documents of a chunk of the lossy count, and the n-grams it holds at most
CHUNK_DOCS, CHUNK_NGRAMS = 8192, 1 << 21
#: an n-gram counted this often is common; the most common COMMON_LIMIT are broadcast (2 MB)
COMMON_FROM, COMMON_LIMIT = 64, 1 << 17
POSTING_BLOCK = 4096
BLOCK_NGRAMS = 1 << 21
#: cells to which the rows of documents to be verified are hashed, to keep other texts out of the shuffle
SIEVE_CELLS = 1 << 20


def ngram_sets(s: Slice, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed n-grams of each text, sorted within it, and how many each text has."""
    words = s.runs(~IS_SPACE)
    h = words.hashes(LOWER)
    grams, first = windows(h, words.doc, n)
    few, whole = short_sequences(h, words.per_doc, n)
    doc = np.concatenate([words.doc[first], few])
    grams = np.concatenate([grams, whole])
    order = np.lexsort((grams, doc))
    doc, grams = doc[order], grams[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (grams[1:] != grams[:-1])
    return grams[new], np.bincount(doc[new], minlength=s.n)


def bitmaps(grams: np.ndarray, counts: np.ndarray, bits: int = BITS) -> np.ndarray:
    """For each set, the parity of its members in each of ``bits`` bins, packed (uint64)."""
    out = np.empty((len(counts), bits // 64), np.uint64)
    ends = np.cumsum(counts)
    step = max(1, (1 << 21) // bits)
    for lo in range(0, len(counts), step):
        c = counts[lo : lo + step]
        g = grams[(ends[lo] - counts[lo]) : ends[lo + len(c) - 1]]
        cell = np.repeat(np.arange(len(c)), c) * bits + (g & np.uint64(bits - 1)).astype(np.int64)
        parity = (np.bincount(cell, minlength=len(c) * bits) & 1).astype(np.uint8)
        out[lo : lo + len(c)] = np.packbits(parity.reshape(len(c), bits), axis=1).view(np.uint64)
    return out


def most_different(a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    """Largest symmetric difference of two sets of sizes a, b that are similar; negative: none."""
    least = -(-num * (a + b) // (num + den))
    fits = (den * np.minimum(a, b) >= num * np.maximum(a, b))
    return np.where(fits, a + b - 2 * least, -1)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _recurring(n: int):
    """n-grams that occur in two or more documents of a chunk, and in how many."""
    schema = pa.schema([("gram", pa.int64()), ("n", pa.int64())])

    def flush(parts: list[np.ndarray]) -> pa.RecordBatch:
        grams, counts = np.unique(np.concatenate(parts), return_counts=True)
        often = counts > 1
        return pa.record_batch([pa.array(_signed(grams[often])), pa.array(counts[often])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, docs, held = [], 0, 0
        for batch in batches:
            for s in slices(batch.column(0)):
                grams, _ = ngram_sets(s, n)
                parts.append(grams)
                docs, held = docs + s.n, held + len(grams)
                if docs >= CHUNK_DOCS or held >= CHUNK_NGRAMS:
                    yield flush(parts)
                    parts, docs, held = [], 0, 0
        if parts:
            yield flush(parts)

    return run


def _prefixes(n: int, num: int, den: int, common: np.ndarray, weight: np.ndarray):
    """Per document: its set's key, size, prefix (rare and common part), group and bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column(1)):
                grams, counts = ngram_sets(s, n)
                doc = np.repeat(np.arange(s.n), counts)
                at = np.minimum(np.searchsorted(common, grams), max(len(common) - 1, 0))
                is_common = common[at] == grams if len(common) else np.zeros(len(grams), bool)
                rank = np.where(is_common, weight[at], 0) if len(common) else np.zeros(len(grams), np.int64)
                order = np.lexsort((grams, rank, doc))
                begin = np.cumsum(counts) - counts
                length = np.where(counts > 0, counts - -(-num * counts // den) + 1, 0)
                inside = np.arange(len(grams)) - begin[doc] < length[doc]
                pick = order[inside]
                pre, pre_doc, pre_common = grams[pick], doc[pick], is_common[pick]
                tag = np.zeros(s.n, np.uint64)
                np.add.at(tag, pre_doc, mix(pre ^ np.uint64(0xA5A5A5A5)))
                group = mix(tag + counts.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                key = np.zeros(s.n, np.uint64)
                np.add.at(key, doc, mix(grams ^ np.uint64(0x5A5A5A5A)))
                key = mix(key + counts.astype(np.uint64))
                lists = []
                for part in (~pre_common, pre_common):
                    sizes = np.bincount(pre_doc[part], minlength=s.n)
                    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                    lists.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(_signed(pre[part]))))
                bits = pa.FixedSizeListArray.from_arrays(pa.array(_signed(bitmaps(grams, counts).reshape(-1))), BITS // 64)
                long = counts > WIDE_FROM
                wide = bitmaps(grams[np.repeat(long, counts)], counts[long], WIDE_BITS)
                offsets = np.concatenate([[0], np.cumsum(long)]).astype(np.int32) * (WIDE_BITS // 64)
                wide = pa.ListArray.from_arrays(pa.array(offsets), pa.array(_signed(wide.reshape(-1))))
                empty = counts == 0
                yield pa.record_batch(
                    [batch.column(0).slice(s.first, s.n), batch.column(2).slice(s.first, s.n), pa.array(_signed(key), mask=empty),
                     pa.array(counts), pa.array(_signed(group), mask=empty), *lists, bits.cast(pa.list_(pa.int64())), wide],
                    names=["doc_id", "row", "key", "n", "gid", "rare", "common", "bits", "wide"])

    return run


class Forest:
    """Union-find over ``n`` nodes."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: int, b: int) -> None:
        ra, rb = self.root[a], self.root[b]
        if ra != rb:
            self.root[self.root == max(ra, rb)] = min(ra, rb)

    def stars(self) -> tuple[np.ndarray, np.ndarray]:
        """Each node that is not its tree's first, and that first node."""
        leaf = np.flatnonzero(self.root != np.arange(len(self.root)))
        return leaf, self.root[leaf]


def _whole_groups(batches: Iterator[pa.RecordBatch], key: list[str], limit: int) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by ``key``, about ``limit`` rows at a time."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in (b.slice(at, limit) for b in batches for at in range(0, b.num_rows, limit)):
        held.append(batch)
        rows += batch.num_rows
        if rows < limit:
            continue
        last = np.ones(batch.num_rows, bool)
        for k in key:
            col = batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False)
            last &= col == col[-1]
        cut = batch.num_rows - int(np.argmin(last[::-1])) if not last.all() else 0
        if cut:
            held[-1] = batch.slice(0, cut)
            yield pa.Table.from_batches(held)
            held = [batch.slice(cut)]
            rows = batch.num_rows - cut
    if rows:
        yield pa.Table.from_batches(held)


def _group_no(table: pa.Table, key: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    for k in key:
        col = table[k].to_numpy()
        new[1:] |= col[1:] != col[:-1]
    return np.cumsum(new)


def _candidates(num: int, den: int):
    """A forest of the groups that meet at an n-gram and pass the size and bitmap filters."""
    key = ["gram", "i", "j"]
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def matrix(col: pa.ChunkedArray, bits: int = BITS) -> np.ndarray:
        return col.combine_chunks().flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, bits // 64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_groups(batches, key, 4 * POSTING_BLOCK):
            no, size, block = _group_no(t, key), t["n"].to_numpy(), t["block"].to_numpy()
            across = t["i"].to_numpy() != t["j"].to_numpy()
            gid, node = np.unique(t["gid"].to_numpy(), return_inverse=True)
            every = matrix(t["every"])
            some = every
            several = t["some"].is_valid().to_numpy()
            if several.any():  # groups of one have their bits in every alone
                some = every.copy()
                some[several] = matrix(t["some"].drop_null())
            # long sets of groups of one: rows of the wide matrix, -1 without
            long = pc.list_value_length(t["wide"]).fill_null(0).to_numpy() > 0
            wide, row = matrix(t["wide"], WIDE_BITS), np.where(long, np.cumsum(long) - 1, -1)
            forest = Forest(len(gid))
            step = 1
            while step < len(no):
                a = np.flatnonzero(no[:-step] == no[step:])
                if not len(a):
                    break
                b = a + step
                open_ = (forest.root[node[a]] != forest.root[node[b]]) & (~across[a] | (block[a] != block[b]))
                a, b = a[open_], b[open_]
                room = most_different(size[a], size[b], num, den)
                a, b, room = a[room >= 0], b[room >= 0], room[room >= 0]
                differ = np.bitwise_count((every[a] & ~some[b]) | (every[b] & ~some[a])).sum(axis=1)
                a, b, room = a[differ <= room], b[differ <= room], room[differ <= room]
                both = long[a] & long[b]
                near = ~both
                near[both] = np.bitwise_count(wide[row[a[both]]] ^ wide[row[b[both]]]).sum(axis=1) <= room[both]
                for x, y in zip(node[a[near]], node[b[near]]):
                    forest.join(x, y)
                step += 1
            u, v = forest.stars()
            if len(u):
                yield pa.record_batch([pa.array(gid[u]), pa.array(gid[v])], schema=schema)

    return run


def _verify(n: int, num: int, den: int):
    """Exact links (a forest of them) within each cluster block, from the texts."""
    key = ["cid", "i", "j"]
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def links(keys: np.ndarray, block: np.ndarray, across: bool, sets: list[np.ndarray]) -> list[tuple[int, int]]:
        order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), keys[i]))
        sets, keys, block = [sets[i] for i in order], keys[order], block[order]
        size = np.array([len(x) for x in sets])
        width = max(BITS, min(1 << 13, 1 << int(4 * size.max() - 1).bit_length()))
        bits = bitmaps(np.concatenate(sets), size, width)
        forest = Forest(len(sets))
        for a in range(len(sets) - 1):
            hi = int(np.searchsorted(size, size[a] * den // num, side="right"))
            b = np.arange(a + 1, hi)
            b = b[forest.root[b] != forest.root[a]]
            if across:
                b = b[block[b] != block[a]]
            if not len(b):
                continue
            room = most_different(size[a], size[b], num, den)
            differ = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1)
            for c in b[(room >= 0) & (differ <= room)]:
                if forest.root[c] != forest.root[a]:
                    both = len(np.intersect1d(sets[a], sets[c], assume_unique=True))
                    if den * both >= num * (size[a] + size[c] - both):
                        forest.join(a, c)
        leaf, root = forest.stars()
        return list(zip(keys[leaf].tolist(), keys[root].tolist()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_groups(batches, key, 256):
            no, keys, block = _group_no(t, key), t["key"].to_numpy(), t["block"].to_numpy()
            across = t["i"].to_numpy() != t["j"].to_numpy()
            sets: list[np.ndarray] = []
            for s in slices(t["text"]):
                grams, counts = ngram_sets(s, n)
                sets += np.split(grams, np.cumsum(counts)[:-1])
            out: list[tuple[int, int]] = []
            for g in range(no[-1] + 1):
                rows = np.flatnonzero(no == g) if no[-1] < 64 else np.arange(*np.searchsorted(no, [g, g + 1]))
                if len(rows) > 1:
                    out += links(keys[rows], block[rows], bool(across[rows[0]]), [sets[r] for r in rows])
            if out:
                u, v = np.array(out, dtype=np.int64).T
                yield pa.record_batch([pa.array(u), pa.array(v)], schema=schema)

    return run


def _in_blocks(rows: DataFrame, by: str, blocks: str, spread: str, parts: int) -> DataFrame:
    """Rows of each ``by`` dealt to ``blocks`` blocks, each block paired with every other.

    Sorted by (``by``, i, j) in partitions of whole pairs; a single block is a pair with itself.
    """
    own = F.pmod(F.xxhash64(spread), F.col(blocks)).cast("int")
    dealt = rows.withColumn("block", own).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col(blocks).cast("int") - 1)))
    paired = dealt.withColumns({"i": F.least("block", "_other"), "j": F.greatest("block", "_other")}).drop("_other", blocks)
    return paired.repartition(parts, by, "i", "j").sortWithinPartitions(by, "i", "j", spread)


def similar(docs: DataFrame, scratch: Scratch, n: int, percent: int) -> DataFrame:
    """Classes of documents linked by Jaccard similarity of ``percent`` or more.

    Returns one row per document: ``doc_id, n_shingles, key`` (its set; null: none) and
    ``component_id``, the least id that it reaches by links.
    """
    spark = docs.sparkSession
    num, den = percent, 100
    id_type = docs.schema["doc_id"].dataType.simpleString()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    recurring = docs.select("text").mapInArrow(tidy(_recurring(n)), "gram bigint, n bigint")
    common = recurring.groupBy("gram").agg(F.sum("n").alias("n")).filter(F.col("n") >= COMMON_FROM)
    common = common.orderBy(F.desc("n"), "gram").limit(COMMON_LIMIT).toArrow()
    grams = common["gram"].to_numpy().view(np.uint64)
    order = np.argsort(grams)
    run = _prefixes(n, num, den, grams[order], common["n"].to_numpy()[order])
    schema = f"doc_id {id_type}, row bigint, key bigint, n bigint, gid bigint, rare array<bigint>, common array<bigint>, bits array<bigint>, wide array<bigint>"
    # an id may repeat with other texts, or be null: a row is known by its id and its text
    row = F.xxhash64("doc_id", "text").alias("row")
    sets = scratch.table(docs.select("doc_id", "text", row).mapInArrow(tidy(run), schema), "sets")

    sets_of = sets.filter("key IS NOT NULL")
    keys = sets_of.groupBy("key").agg(F.min("doc_id").alias("rep"), F.min("row").alias("row"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("gid").alias("gid"))
    keys = scratch.table(keys, "keys")
    lanes = range(BITS // 64)
    groups = sets_of.groupBy("gid").agg(
        *[F.first(c).alias(c) for c in ("n", "rare", "common", "wide")],
        *[F.bit_and(F.col("bits")[i]).alias(f"e{i}") for i in lanes], *[F.bit_or(F.col("bits")[i]).alias(f"s{i}") for i in lanes])
    groups = groups.join(keys.groupBy("gid").agg(F.count(F.lit(1)).alias("members")), "gid")
    several = F.col("members") > 1
    groups = scratch.table(groups.select(
        "gid", "members", "n", "rare", "common", F.array(*[f"e{i}" for i in lanes]).alias("every"),
        F.when(several, F.array(*[f"s{i}" for i in lanes])).alias("some"), F.when(~several, F.col("wide")).alias("wide")), "groups")

    # rare n-grams: of the groups that share one, those with a neighbour in order of size that is not
    # too much smaller or larger; if the nearest sizes do not fit, no other in the list does
    # common ones: lists of known length, cut into blocks
    rare = groups.select("gid", "n", F.explode("rare").alias("gram"))
    by_size = Window.partitionBy("gram").orderBy("n")
    fits = lambda other: F.col(other).isNotNull() & (F.least("n", other) * den >= F.greatest("n", other) * num)
    rare = rare.withColumns({"_before": F.lag("n").over(by_size), "_after": F.lead("n").over(by_size)})
    rare = rare.filter(fits("_before") | fits("_after")).drop("_before", "_after", "n")
    rare = rare.withColumn("_met", F.count(F.lit(1)).over(Window.partitionBy("gram")))
    often = groups.select("gid", F.explode("common").alias("gram"))
    length = often.groupBy("gram").agg(F.count(F.lit(1)).alias("_met")).filter("_met > 1")  # at most COMMON_LIMIT rows
    often = often.join(F.broadcast(length), "gram")
    met = rare.unionByName(often).withColumn("blocks", F.ceil(F.col("_met") / POSTING_BLOCK)).drop("_met")
    met = met.join(groups.select("gid", "n", "every", "some", "wide"), "gid")
    met = _in_blocks(met, "gram", "blocks", "gid", parts)
    edges = met.select("gram", "i", "j", "block", "gid", "n", "every", "some", "wide").mapInArrow(tidy(_candidates(num, den)), "u bigint, v bigint")
    clusters = components(edges, scratch, "clusters")

    member = keys.join(groups.select("gid", "members"), "gid").select("key", "row", "n", "gid", "members")
    member = member.join(clusters.withColumnRenamed("node", "gid"), "gid", "left")
    member = member.filter("root IS NOT NULL OR members > 1").select("key", "row", "n", F.coalesce("root", "gid").alias("cid"))
    member = scratch.table(member, "members")
    weights = member.groupBy("cid").agg(F.ceil(F.sum("n") / BLOCK_NGRAMS).alias("blocks"))
    member = member.join(weights, "cid").select("key", "cid", "blocks", "row")
    # first a sieve of bounded size, so that texts which need no verification are not shuffled
    cell = F.pmod("row", F.lit(SIEVE_CELLS)).cast("int").alias("cell")
    needed = scratch.table(member.select(cell).distinct(), "sieve")
    sieved = docs.select(row, "text").withColumn("cell", cell).join(F.broadcast(needed), "cell", "left_semi")
    texts = sieved.groupBy("row").agg(F.first("text").alias("text")).join(member, "row")
    texts = _in_blocks(texts.select("cid", "blocks", "key", "text"), "cid", "blocks", "key", parts)
    links = texts.select("cid", "i", "j", "block", "key", "text").mapInArrow(tidy(_verify(n, num, den)), "u bigint, v bigint")
    linked = components(links, scratch, "links")

    classes = keys.select("key", "rep", "copies").join(linked.withColumnRenamed("node", "key"), "key", "left")
    classes = classes.withColumn("root", F.coalesce("root", "key"))
    least = classes.groupBy("root").agg(F.min("rep").alias("component_id"))
    classes = scratch.table(classes.join(least, "root").select("key", "component_id", "copies"), "classes")
    rows = sets.select("doc_id", F.col("n").alias("n_shingles"), "key")
    with_set = attach(rows.filter("key IS NOT NULL"), classes, "key", "copies").drop("copies")
    alone = rows.filter("key IS NULL").withColumn("component_id", F.col("doc_id"))
    return with_set.select("doc_id", "n_shingles", "key", "component_id").unionByName(alone)


def one_of_each(docs: DataFrame, scratch: Scratch, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each class the row with the least id stays
    (ids that repeat with other texts: the least hash of the text), with all its columns."""
    key, text_key = free_names(docs.columns, "_id", "_text_hash")
    identity = F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text"))
    found = similar(docs.select(identity.alias("doc_id"), "text"), scratch, n, percent)
    stay = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stay = stay.select(F.col("doc_id.id").alias(key), F.col("doc_id.text").alias(text_key)).distinct()
    marked = docs.withColumn(text_key, F.xxhash64("text"))
    joined = marked.join(stay, marked["doc_id"].eqNullSafe(stay[key]) & (marked[text_key] == stay[text_key])).drop(marked[text_key])
    return joined.dropDuplicates([key, text_key]).select(*[F.col(f"`{c}`") for c in docs.columns])


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return similar(docs, Scratch(spark, "ngram-join"), 3, 90).select("doc_id", "n_shingles", "component_id")
