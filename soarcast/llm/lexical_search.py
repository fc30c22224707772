"""Ranked lexical search over an inverted index in shards, by Block-Max MaxScore.

**Index.** ``build_index`` reads whole texts once. Each task cuts its rows into shards of at most
``SHARD_BYTES`` of text (or one longer text) and ``SHARD_DOCS`` rows, numbers the documents of a
shard by ascending length, and writes one posting list per term and shard. A list is cut at every
``WINDOW`` document numbers: its ``head`` has four bytes a block (window, postings, highest
frequency), its ``body`` two bytes a posting (number within the window, frequency; frequencies of
255 and more stand in ``extra``). As documents of a window are of like length, the highest frequency
and the shortest length of a block give a tight bound of its scores. The row of term 0 is the
shard's directory: ids and lengths. The index is a Parquet table in the shared folder, so lost
executors cost only running tasks, and it can be searched again by other queries.

**Search.** Queries are taken in blocks of about ``BLOCK_PAIRS`` (query, term) pairs, so what is
broadcast is bounded; the lists of a block's terms are shuffled by shard, a few MB each. In a shard,
each query takes windows by descending bound, in batches that grow fourfold. Lists are ordered by
their global bound: those whose bounds sum to less than the score needed are non-essential and
produce no candidates. Candidates come from the blocks of the essential lists; then the block
maxima of the non-essential ones, greatest list first, reject candidates, and only blocks in
whose window a candidate survives are unpacked. Every shard returns its best ``k`` rows a query,
and a window over the shards' rows merges them (the group limit cuts each task to ``k`` first).

A document's score for a query follows the contract: integer arithmetic, rounded down. Terms are
compared by 64-bit hashes.

Defined results: a null or empty text has no terms, is not counted in N, and is found by nothing;
a query without terms, or whose terms occur nowhere, has no rows; repeated rows are documents of
their own; among equal scores the least id comes first and a null id last; queries of one id with
different texts are ranked apart, identical rows of a query once; other columns are not read; empty
tables give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import Scratch
from .text import IS_DIGIT, IS_LETTER, LOWER, slices

SHARD_BYTES, SHARD_DOCS, WINDOW = 16 << 20, 1 << 20, 256
BLOCK_PAIRS = 200_000
TOP = 10
#: windows a query takes first
FIRST_BATCH = 4
_IS_TERM = IS_LETTER | IS_DIGIT
#: term number of a shard's directory row
_DIRECTORY = 0
#: scores are w * (SCALE * tf) div (1000 * tf + 8 * m); without the length part they approach SCALE / 1000
SCALE, _MOST = 1_000_000_000, 1_000_000
_ESCAPE = 255


def _term_hashes(words) -> np.ndarray:
    """Hashes of terms as signed numbers; the directory's number is left free."""
    h = words.hashes(LOWER).view(np.int64)
    return np.where(h == _DIRECTORY, 1, h)


# --- index ------------------------------------------------------------------------------


def _postings(term: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (term, doc) in order and how often each occurs; ``doc`` ascends."""
    order = np.argsort(term, kind="stable")
    term, doc = term[order], doc[order]
    at = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])]) if len(term) else np.zeros(0, np.int64)
    return term[at], doc[at], np.diff(np.r_[at, len(term)])


def _binary(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Consecutive runs of ``values`` (beginning at ``starts``) as binary values."""
    offsets = (np.r_[starts, len(values)] * values.itemsize).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(values.tobytes())])


class _Shard:
    """Collects the documents of a shard and turns them into index rows."""

    def __init__(self, id_type: pa.DataType):
        self.id_type, self.ids, self.lengths, self.found = id_type, [], [], []
        self.docs = self.bytes = 0

    def add(self, ids: pa.Array, s) -> None:
        words = s.runs(_IS_TERM)
        self.ids.append(ids)
        self.lengths.append(words.per_doc)
        self.found.append(_postings(_term_hashes(words), words.doc + self.docs))
        self.docs += s.n
        self.bytes += len(s.data)

    def rows(self, number: int) -> pa.RecordBatch:
        length = np.concatenate(self.lengths)
        by_length = np.argsort(length, kind="stable")
        place = np.empty(self.docs, np.int64)
        place[by_length] = np.arange(self.docs)
        term, doc, tf = (np.concatenate(x) for x in zip(*self.found))
        order = np.lexsort((place[doc], term))
        term, doc, tf = term[order], place[doc][order], tf[order]
        first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.zeros(0, np.int64)
        window = doc // WINDOW
        new_list = np.zeros(len(term), bool)
        new_list[first] = True
        block = np.flatnonzero(new_list | np.r_[True, window[1:] != window[:-1]]) if len(term) else np.zeros(0, np.int64)
        size = np.diff(np.r_[block, len(term)])
        peak = np.minimum(np.maximum.reduceat(tf, block), _ESCAPE) if len(block) else np.zeros(0, np.int64)
        head = (window[block] << 16 | (size - 1) << 8 | peak).astype("<u4")
        body = (doc % WINDOW << 8 | np.minimum(tf, _ESCAPE)).astype("<u2")
        large = tf >= _ESCAPE
        extra, before = tf[large].astype("<i4"), np.r_[0, np.cumsum(large)]
        lists = pa.record_batch([
            pa.array(np.full(len(first), number)), pa.array(term[first]), pa.array(np.diff(np.r_[first, len(term)]).astype(np.int64)),
            pa.nulls(len(first), pa.int64()), _binary(head, np.searchsorted(block, first)), _binary(body, first), _binary(extra, before[first]),
            pa.nulls(len(first), pa.list_(self.id_type))], names=_COLUMNS)
        ids = pa.concat_arrays([i.cast(self.id_type) for i in self.ids]).take(pa.array(by_length))
        directory = pa.record_batch([
            pa.array([number]), pa.array([_DIRECTORY]), pa.array([int((length > 0).sum())]), pa.array([int(length.sum())]), pa.array([b""], pa.large_binary()),
            pa.array([length[by_length].astype("<i4").tobytes()], pa.large_binary()), pa.array([b""], pa.large_binary()),
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)], names=_COLUMNS)
        at = int(np.searchsorted(term[first], _DIRECTORY))  # rows in order of terms
        return pa.Table.from_batches([lists.slice(0, at), directory, lists.slice(at)]).combine_chunks().to_batches()[0]


_COLUMNS = ["shard", "term", "df", "total", "head", "body", "extra", "ids"]


def build_index(docs: DataFrame, scratch: Scratch, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The written index of ``docs`` (``doc_id, text``): see the module's description."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard = TaskContext.get().partitionId() << 32, None
        for batch in batches:
            for s in slices(batch.column(1)):
                if shard and (shard.bytes + len(s.data) > shard_bytes or shard.docs + s.n > SHARD_DOCS):
                    yield shard.rows(number)
                    number, shard = number + 1, None
                shard = shard or _Shard(batch.schema.field(0).type)
                shard.add(batch.column(0).slice(s.first, s.n), s)
        if shard:
            yield shard.rows(number)

    schema = f"shard bigint, term bigint, df bigint, total bigint, head binary, body binary, extra binary, ids array<{id_type}>"
    return scratch.table(docs.select("doc_id", "text").mapInArrow(run, schema), "index")


# --- search -----------------------------------------------------------------------------


@dataclass
class Queries:
    """A block of queries: terms and weights of query ``i`` lie from ``cut[i]`` to ``cut[i + 1]``."""

    ids: pa.Array
    cut: np.ndarray
    terms: np.ndarray
    weights: np.ndarray
    n_docs: int
    n_terms: int
    top: int


class PostingList:
    """One term in one shard; blocks are unpacked when asked for."""

    def __init__(self, head: bytes, body: bytes, extra: bytes, least_m: np.ndarray):
        packed = np.frombuffer(head, "<u4").astype(np.int64)
        self.window, self.size, peak = packed >> 16, (packed >> 8 & 255) + 1, packed & 255
        self.start = np.cumsum(self.size) - self.size
        self.body, self.extra = np.frombuffer(body, "<u2"), np.frombuffer(extra, "<i4")
        #: block maxima: highest frequency at the least length of the window
        self.bound = np.where(peak < _ESCAPE, SCALE * peak // (1000 * peak + 8 * least_m[self.window]), _MOST)
        self.most = int(self.bound.max())

    def unpack(self, blocks: np.ndarray, row_of: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell (batch row * WINDOW + number) and unweighted score of the postings of ``blocks``."""
        size = self.size[blocks]
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        at = np.repeat(self.start[blocks], size) + within
        packed = self.body[at].astype(np.int64)
        low, tf = packed >> 8, packed & 255
        if len(self.extra):
            full = tf == _ESCAPE
            rank = np.cumsum((self.body & 255) == _ESCAPE) - 1
            tf[full] = self.extra[rank[at[full]]]
        window = np.repeat(self.window[blocks], size)
        return row_of[window] * WINDOW + low, SCALE * tf // (1000 * tf + 8 * m[window * WINDOW + low])


class ShardSearch:
    """Block-Max MaxScore over the posting lists of one shard."""

    def __init__(self, lists: dict[int, tuple[bytes, bytes, bytes]], length: np.ndarray, id_rank: np.ndarray, q: Queries):
        self.windows = -(-len(length) // WINDOW)
        m = 100 - 90 + (90 * length.astype(np.int64) * q.n_docs) // max(q.n_terms, 1)
        self.m = np.r_[m, np.full(self.windows * WINDOW - len(m), m[-1] if len(m) else 1)]
        self.id_rank = id_rank
        least = self.m[::WINDOW]  # documents are ordered by length
        self.lists = {t: PostingList(*parts, least) for t, parts in lists.items()}
        #: blocks unpacked so far
        self.unpacked = 0

    def top(self, terms: np.ndarray, weights: np.ndarray, k: int, need: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and scores of the ``k`` best documents that score ``need`` or more, best first."""
        mine = [(w * self.lists[t].most, w, self.lists[t]) for t, w in zip(terms.tolist(), weights.tolist()) if w > 0 and t in self.lists]
        mine.sort(key=lambda x: x[0])
        best, score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not mine:
            return best, score
        prefix = np.cumsum([x[0] for x in mine])
        bound = np.zeros(self.windows, np.int64)
        for _, w, p in mine:
            bound[p.window] += w * p.bound
        order = np.argsort(-bound, kind="stable")
        at, take = 0, FIRST_BATCH
        while at < len(order) and bound[order[at]] >= need:
            batch = order[at : at + take]
            at, take = at + take, 4 * take
            doc, value = self._batch(mine, prefix, batch[bound[batch] >= need], need)
            best, score = np.r_[best, doc], np.r_[score, value]
            first = np.lexsort((self.id_rank[best], -score))[:k]
            best, score = best[first], score[first]
            if len(best) == k:
                need = max(need, int(score[-1]))  # an equal score may still win by its id
        return best, score

    def _batch(self, mine: list, prefix: np.ndarray, batch: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of some windows that score ``need`` or more, and their scores."""
        row_of = np.full(self.windows, -1)
        row_of[batch] = np.arange(len(batch))
        total = np.zeros(len(batch) * WINDOW, np.int64)
        essential = int(np.searchsorted(prefix, need))
        for _, w, p in mine[essential:]:
            blocks = np.flatnonzero(row_of[p.window] >= 0)
            if len(blocks):
                cell, value = p.unpack(blocks, row_of, self.m)
                total[cell] += w * value
                self.unpacked += len(blocks)
        total = total.reshape(-1, WINDOW)
        candidate = total > 0
        # block maxima of the non-essential lists up to each, by window
        ceiling = np.zeros((essential + 1, len(batch)), np.int64)
        for i, (_, w, p) in enumerate(mine[:essential]):
            row = row_of[p.window]
            ceiling[i + 1, row[row >= 0]] = w * p.bound[row >= 0]
        np.cumsum(ceiling, axis=0, out=ceiling)
        for i in range(essential, 0, -1):
            candidate &= total + ceiling[i][:, None] >= need
            alive = candidate.any(axis=1)
            _, w, p = mine[i - 1]
            row = row_of[p.window]
            blocks = np.flatnonzero((row >= 0) & alive[row])
            if len(blocks):
                cell, value = p.unpack(blocks, row_of, self.m)
                kept = candidate.reshape(-1)[cell]
                total.reshape(-1)[cell[kept]] += w * value[kept]
                self.unpacked += len(blocks)
        row, low = np.nonzero(candidate & (total >= need))
        return batch[row] * WINDOW + low, total[row, low]


def _searcher(shared: Broadcast) -> Callable[[pa.Table], pa.Table]:
    #: by query, the k-th best score of the shards this task has searched: no less can win any more
    floors: list[int] = []

    def run(table: pa.Table) -> pa.Table:
        q = shared.value
        if not floors:
            floors.extend([1] * len(q.ids))
        return _search_shard(table, q, floors)

    return run


def _search_shard(table: pa.Table, q: Queries, floors: list[int]) -> pa.Table:
    lists, directory = {}, None
    for term, head, body, extra, ids in zip(*(table[c].to_pylist() for c in ("term", "head", "body", "extra")), table["ids"]):
        if term == _DIRECTORY:
            directory = np.frombuffer(body, "<i4"), ids.values
        else:
            lists[term] = head, body, extra
    length, ids = directory
    id_rank = np.empty(len(ids), np.int64)
    id_rank[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
    shard = ShardSearch(lists, length, id_rank, q)
    query, doc, score = [], [], []
    for i in range(len(q.cut) - 1):
        best, value = shard.top(q.terms[q.cut[i] : q.cut[i + 1]], q.weights[q.cut[i] : q.cut[i + 1]], q.top, floors[i])
        if len(best) == q.top:
            floors[i] = max(floors[i], int(value[-1]))
        query.append(np.full(len(best), i))
        doc.append(best)
        score.append(value)
    query, doc, score = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (query, doc, score))
    return pa.table({
        "query": pa.array(query.astype(np.int32)), "item_id": q.ids.take(pa.array(query.astype(np.int64))),
        "doc_id": ids.take(pa.array(doc)), "score": pa.array(score)})


def _query_terms(queries: DataFrame) -> DataFrame:
    """``item_id, text_hash, term``: the distinct terms of each distinct query."""
    id_type = queries.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column(2)):
                words = s.runs(_IS_TERM)
                term, doc, _ = _postings(_term_hashes(words), words.doc)
                own = pa.array(doc + s.first)
                yield pa.record_batch([batch.column(0).take(own), batch.column(1).take(own), pa.array(term)], names=["item_id", "text_hash", "term"])

    rows = queries.select("item_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, f"item_id {id_type}, text_hash bigint, term bigint").distinct()


def _block(rows: pa.Table, n_docs: int, n_terms: int, top: int) -> Queries:
    rows = rows.sort_by([("text_hash", "ascending"), ("item_id", "ascending")])
    ids, text = rows["item_id"].combine_chunks(), rows["text_hash"].to_numpy()
    code = np.zeros(len(rows), np.int64) if not len(rows) else ids.dictionary_encode(null_encoding="encode").indices.to_numpy()
    cut = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (code[1:] != code[:-1])]) if len(rows) else np.zeros(0, np.int64)
    return Queries(ids.take(pa.array(cut)), np.r_[cut, len(rows)], rows["term"].to_numpy(), rows["weight"].to_numpy(), n_docs, n_terms, top)


def search(index: DataFrame, queries: DataFrame, scratch: Scratch, top: int = TOP, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each query (``item_id, text``)."""
    spark = index.sparkSession
    n_docs, n_terms = index.filter(F.col("term") == _DIRECTORY).agg(
        F.coalesce(F.sum("df"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    asked = scratch.table(_query_terms(queries), "query-terms")
    df = index.select("term", "df").join(asked.select("term").distinct(), "term").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("bigint")
    weighted = scratch.table(asked.join(df, "term").withColumn("weight", weight).drop("df"), "query-weights")
    blocks = max(math.ceil(weighted.count() / block_pairs), 1)
    id_type, item_type = index.schema["ids"].dataType.elementType.simpleString(), queries.schema["item_id"].dataType.simpleString()
    found = []
    for b in range(blocks):
        mine = weighted.filter(F.pmod(F.xxhash64("item_id", "text_hash"), F.lit(blocks)) == b)
        shared = spark.sparkContext.broadcast(_block(mine.toArrow(), n_docs, n_terms, top))

        wanted = mine.select("term").union(spark.range(1).select(F.lit(_DIRECTORY).cast("bigint").alias("term"))).distinct()
        lists = index.join(F.broadcast(wanted), "term", "left_semi").select("shard", "term", "head", "body", "extra", "ids")
        best = lists.groupBy("shard").applyInArrow(_searcher(shared), f"query int, item_id {item_type}, doc_id {id_type}, score bigint")
        found.append(best.withColumn("block", F.lit(b)))
    order = Window.partitionBy("block", "query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "lexical-search")
    index = build_index(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), scratch)
    return search(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"), scratch)


_TERMS = r"unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"
#: independent DuckDB statement of ``op11``
SQL = f"""
WITH found AS (SELECT doc_id, {_TERMS} AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM found GROUP BY ALL),
len AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY ALL),
total AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM len),
asked AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, {_TERMS} AS term FROM benchmark)),
weight AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM tf, total WHERE term IN (SELECT term FROM asked) GROUP BY term, n_docs),
scored AS (
    SELECT item_id, doc_id,
        sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
    FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN len USING (doc_id), total GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""
