"""Periodic runs of words, found by uniting suffix classes in descending order of their common prefix.

A run is a maximal stretch of words with smallest period ``q`` and at least ``2 * q`` words. In
the order of a text's suffixes, neighbours share a prefix (LCP) of known length. Taken by
descending LCP, as Kruskal takes edges, each pair unites two classes of suffixes; a class keeps
its positions in order. Two positions at distance ``d`` that become neighbours in a class at
level ``lcp >= d`` seed the stretch of ``d + lcp`` words with period ``d``: no position between
them starts the same words, so ``d`` is its smallest period (a smaller one would divide ``d`` and
have put a position between them at a higher level). A stretch that no equal word extends to the
left is a run, and each run is found exactly once.

A run of ``max(MIN_LENGTH, 2 * q)`` words has two suffixes whose LCP is ``MIN_LENGTH / 2`` or more,
so only positions whose next ``MIN_LENGTH / 2`` words occur again in the text take part; the rest
of a text is read once by numpy. Suffixes are sorted by prefix doubling, all texts of a slice at a
time; memory is a few arrays of a slice (about one MB of text, or one longer text). Texts are
independent: there is no shuffle, and a lost executor costs its running tasks only. Words are
compared by 64-bit hashes.

Defined results: a null, empty or blank text has no words, no runs and collapses to the empty
string; repeated rows and rows with a null id are each handled for themselves; among runs of equal
length the least start, then the least period is the longest; columns beyond ``doc_id`` and
``text`` are not read; an empty table gives none.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch
from .text import IS_SPACE, mix, slices, windows

#: words of the shortest run
MIN_LENGTH = 12
SEED_LCP = MIN_LENGTH // 2
_SPACES = r"[\x20\x09-\x0D]+"


def _repeating(values: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Texts in which some ``SEED_LCP`` consecutive words occur twice."""
    grams, first = windows(values, doc, SEED_LCP)
    own = mix(grams + doc[first].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(own)
    again = order[1:][own[order][1:] == own[order][:-1]]
    return np.unique(doc[first[again]])


def suffix_order(values: np.ndarray, doc: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Group starts of all suffixes in their sorted order, as ``rank`` by position.

    ``last`` is, by position, the position after the text's end. Suffixes of other texts never
    share a group; a suffix that ends sorts first.
    """
    n = len(values)
    order = np.lexsort((values, doc))
    new = np.ones(n, bool)
    new[1:] = (values[order][1:] != values[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    width, open_ = 1, np.arange(n)
    while True:
        size = np.bincount(rank[open_], minlength=n)
        open_ = open_[size[rank[open_]] > 1]
        if not len(open_):
            return rank
        ahead = open_ + width
        inside = ahead < last[open_]
        second = np.where(inside, rank[np.where(inside, ahead, 0)] + 1, 0)
        key = rank[open_] * np.int64(n + 1) + second
        by = np.argsort(key, kind="stable")
        open_, key = open_[by], key[by]
        old = rank[open_]
        at = np.arange(len(open_))
        group = np.maximum.accumulate(np.where(np.r_[True, old[1:] != old[:-1]], at, 0))
        part = np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], at, 0))
        rank[open_] = old + part - group
        width *= 2


def _shared_with(before: np.ndarray, words: list[int], ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions that have a neighbour ``before`` them in suffix order, and the words they share.

    Positions are walked in text order: the suffixes after a pair share one word less, so a pair
    that still shares a seed shares at least that many.
    """
    at = np.flatnonzero(before >= 0)
    other = before[at]
    most = ends[at] - np.maximum(at, other)
    shared, k, previous = [], 0, -2
    for i, j, stop in zip(at.tolist(), other.tolist(), most.tolist()):
        k = k - 1 if k > SEED_LCP and i == previous + 1 else 0
        while k < stop and words[i + k] == words[j + k]:
            k += 1
        shared.append(k)
        previous = i
    return at, np.array(shared, np.int64)


def _seeds(pairs: Iterator[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """Unite classes by ``(lcp, i, j)`` of descending lcp; yield ``(position, distance, lcp)``."""
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}

    def find(x: int) -> int:
        if x not in parent:
            parent[x], members[x] = x, [x]
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for lcp, i, j in pairs:
        a, b = find(i), find(j)
        if len(members[a]) < len(members[b]):
            a, b = b, a
        large, small = members[a], members.pop(b)
        parent[b] = a
        for t, x in enumerate(small):
            k = bisect_left(large, x)
            # neighbours in the united class are of the two classes in turn
            if k and (not t or small[t - 1] < large[k - 1]) and x - large[k - 1] <= lcp:
                yield large[k - 1], x - large[k - 1], lcp
            if k < len(large) and (t + 1 == len(small) or small[t + 1] > large[k]) and large[k] - x <= lcp:
                yield x, large[k] - x, lcp
        if small[0] > large[-1]:
            large += small
        elif 32 * len(small) > len(large):
            large += small
            large.sort()  # two ordered stretches: merged in linear time
        else:
            for x in small:
                insort(large, x)


def find_runs(values: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Rows ``(text, start, length, period)`` of all runs, by text, start and period.

    ``values`` are word hashes of consecutive texts, ``doc`` their text numbers in order;
    ``start`` counts from the text's first word.
    """
    none = np.zeros((0, 4), np.int64)
    texts = _repeating(values, doc)
    if not len(texts):
        return none
    chosen = np.flatnonzero(np.isin(doc, texts))
    values, doc = values[chosen], doc[chosen]
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    count = np.diff(np.r_[first, len(doc)])
    begin, last = np.repeat(first, count), np.repeat(first + count, count)
    rank = suffix_order(values, doc, last)
    grams, at = windows(values, doc, SEED_LCP)
    own = mix(grams + doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, group, size = np.unique(own, return_inverse=True, return_counts=True)
    active = at[size[group] > 1]
    order = active[np.argsort(rank[active])]
    before = np.full(len(values), -1, np.int64)
    same = doc[order[1:]] == doc[order[:-1]]
    before[order[1:][same]] = order[:-1][same]
    words = values.tolist()
    position, lcp = _shared_with(before, words, last)
    enough = lcp >= SEED_LCP
    position, lcp = position[enough], lcp[enough]
    by = np.argsort(-lcp, kind="stable")
    pairs = zip(lcp[by].tolist(), position[by].tolist(), before[position[by]].tolist())
    starts, out = begin.tolist(), []
    for i, d, k in _seeds(pairs):
        if d + k >= MIN_LENGTH and (i == starts[i] or words[i - 1] != words[i - 1 + d]):
            out.append((int(doc[i]), i - starts[i], d + k, d))
    return np.array(sorted(out, key=lambda r: (r[0], r[1], r[3])), np.int64).reshape(-1, 4)


def collapse(text: bytes, runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside all runs' parts after their first period, joined by one space."""
    words = text.split()
    if runs:
        keep = np.ones(len(words), bool)
        for start, length, period in runs:
            keep[start + period : start + length] = False
        words = [w for w, k in zip(words, keep.tolist()) if k]
    return b" ".join(words)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``runs`` (array of start, length, period by start, then period) and ``collapsed`` text."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column(1)):
                words = s.runs(~IS_SPACE)
                found = find_runs(words.hashes(), words.doc)
                cut = np.searchsorted(found[:, 0], np.arange(s.n + 1))
                collapsed = [
                    collapse(s.data[s.offsets[i] : s.offsets[i + 1]].tobytes(), list(map(tuple, found[cut[i] : cut[i + 1], 1:].tolist())))
                    for i in range(s.n)]
                runs = pa.StructArray.from_arrays([pa.array(found[:, c]) for c in (1, 2, 3)], names=["start", "length", "period"])
                yield pa.record_batch(
                    [batch.column(0).slice(s.first, s.n), pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), runs),
                     pa.array(collapsed, pa.binary()).cast(pa.string())], names=["doc_id", "runs", "collapsed"])

    schema = f"doc_id {id_type}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The contract's texts: one in ten is made periodic from a word on, by its id's CRC.

    With ``h = crc32(id)``, ``g = h div 10``, ``n`` words, ``h % 10 = 0`` and ``n > 0``, every word
    from ``a = g % n`` on becomes word ``a + (i - a) % p``, ``p = 1 + (n - a) div (3 + g % 8)``.
    Other texts, and those of a null id, stay as they are.
    """
    h, g, words, n, a, p = "_h", "_g", "_words", "_n", "_a", "_p"
    with_words = docs.select(
        "doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias(h)).withColumns(
        {words: F.when((F.col(h) % 10 == 0) & F.col("text").isNotNull(), F.array_remove(F.split("text", _SPACES, -1), "")),
         g: F.floor(F.col(h) / 10)})
    sized = with_words.withColumn(n, F.coalesce(F.size(words), F.lit(0)).cast("bigint"))
    placed = sized.withColumn(a, F.when(F.col(n) > 0, F.expr(f"{g} % {n}"))).withColumn(
        p, F.expr(f"1 + ({n} - {a}) div (3 + {g} % 8)"))
    cycle = f"slice({words}, cast({a} + 1 as int), cast({p} as int))"
    tail = f"slice(flatten(array_repeat({cycle}, cast(({n} - {a}) div {p} + 1 as int))), 1, cast({n} - {a} as int))"
    head = f"slice({words}, 1, cast({a} as int))"
    return placed.select("doc_id", F.expr(f"if({n} > 0, array_join(concat({head}, {tail}), ' '), text)").alias("text"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    Scratch(spark, "periodic-runs")  # for the workers' import path
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = periodic_runs(with_planted_runs(docs))
    # greatest length, then least start, then least period
    best = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("_best.start")).alias("start"), F.col("_best.length").alias("length"), (-F.col("_best.period")).alias("period"),
        F.expr("(1000 * _best.length) div (-_best.period)").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
