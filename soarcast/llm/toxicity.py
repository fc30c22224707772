"""Toxicity by class-conditional Kneser-Ney models over the bytes of words.

Two models of order ``ORDER``, one of toxic and one of ordinary labelled documents, spell
out words byte by byte. Only the highest order has counts of its own class; every lower
order is one continuation distribution counted over both classes, so an expression that
neither class knows costs nearly the same in both, and a rare one is smoothed by how its
parts occur anywhere. A word's evidence is the difference of the two log-likelihoods. A
document is described by its length-normalised difference (per byte, over all words and
over its distinct words), by its strongest word and ``TOP_WORDS`` strongest words, in total
and per byte, by its distinct words' evidence beyond 2 and 4, and by their number, so a few
toxic words in a long text are not averaged away. A logistic regression on labelled
documents that the models have not seen turns these into a probability.

Counting covers every labelled training document and is distributed: distinct words by
class, then distinct byte n-grams, then sums. An n-gram is its own key (its bytes and length
in 64 bits), so every distinct n-gram and context keeps its exact counts. The tables are
broadcast, sent once: they hold one row per distinct n-gram, so they grow with the labelled
text (about 30 bytes an n-gram, on the driver and in each worker). The regression is fitted
on at most ``FIT_DOCS`` documents, the ones with the least hash.

Defined results: null and empty texts, and texts without letters, have no evidence and get
the score of a document without any; a null id counts as the empty text for the fold;
documents without a label are scored only; contradicting labels of one id count as toxic;
the regression takes fold 4, or another split of folds 1 to 4 where fold 4 or the rest lacks a
class (``labels.calibration_part``); with fewer than two ids of a class every score is the share
of toxic ones (0 with no labels at all).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .labels import calibration_part, fold, labelled, sample
from .logistic import Logistic, fit_logistic
from .scratch import Scratch, free_names
from .skew import sieve
from .text import IS_LETTER, LOWER, Slice, Spans, mix, slices
from .workers import tidy

ORDER = 6
DISCOUNT = 0.75
#: an n-gram of up to 7 bytes is one integer: its bytes below, its length in the bits from here on
LENGTH_AT = 56
TOP_WORDS = 3
#: bytes of text that a worker counts or scores at a time (its arrays take some 100 times as much)
SLICE_BYTES = 1 << 20
#: words whose evidence a worker remembers, each in the place that its hash gives (16 bytes a place)
MEMO_PLACES = 1 << 17
FIT_DOCS = 50_000
FEATURES = 9
#: bytes that stand for the start and the end of a word
_START, _END = 1, 2


def distinct_words(words: Spans) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First occurrence of each distinct (lower-cased) word, its hash, and each word's index."""
    hashes, first, inverse = np.unique(words.hashes(LOWER), return_index=True, return_inverse=True)
    return first, hashes, inverse


def word_bytes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words as ``^word$`` one after another (``^`` is 1, ``$`` is 2), and where each begins."""
    length = end - start
    offsets = np.concatenate([[0], np.cumsum(length + 2)])
    out = np.empty(offsets[-1], np.uint8)
    out[offsets[:-1]] = _START
    out[offsets[1:] - 1] = _END
    inner = np.ones(offsets[-1], bool)
    inner[offsets[:-1]] = False
    inner[offsets[1:] - 1] = False
    at = np.arange(offsets[-1])[inner]
    word = np.repeat(np.arange(len(length)), length)
    out[inner] = LOWER[data[start[word] + at - offsets[word] - 1]]
    return out, offsets


def _grams(text: np.ndarray, offsets: np.ndarray) -> list[tuple]:
    """For each predicted byte, by order: its n-gram and that n-gram's context.

    The top n-gram of a byte has ``ORDER`` bytes, or reaches back to the start of the word.
    Integers of places that are not ``inside`` mean nothing.
    """
    place = np.arange(len(text)) - np.repeat(offsets[:-1], np.diff(offsets))
    out = []
    body = np.zeros(len(text), np.int64)
    context = np.zeros(len(text), np.int64)
    for k in range(1, ORDER + 1):
        back = k - 1
        body[back:] += text[: max(len(text) - back, 0)].astype(np.int64) << (8 * back)
        gram = body + (k << LENGTH_AT)
        inside = (place >= max(k - 1, 1))
        top = (place >= 1) & (np.minimum(place + 1, ORDER) == k)
        out.append((k, gram, context, inside, top))
        context = np.zeros(len(text), np.int64)
        context[1:] = gram[:-1]
    return out


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of each slice with their occurrences in toxic and ordinary documents."""
    for batch in batches:
        toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        for s in slices(batch.column(0), SLICE_BYTES):
            words = s.runs(IS_LETTER)
            if not len(words):
                continue
            first, _, inverse = distinct_words(words)
            label = toxic[s.first + words.doc]
            n1 = np.bincount(inverse, weights=label, minlength=len(first)).astype(np.int64)
            n0 = np.bincount(inverse, minlength=len(first)) - n1
            low = LOWER[s.data].tobytes()
            spelled = [low[a:b] for a, b in zip(words.start[first].tolist(), words.end[first].tolist())]
            yield pa.record_batch([pa.array(spelled, pa.binary()), pa.array(n1), pa.array(n0)], names=["word", "n1", "n0"])


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-grams of all orders: highest-order counts by class, and that the n-gram occurs."""
    for batch in batches:
        if not batch.num_rows:
            continue
        words = batch.column(0)
        lengths = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        data = np.frombuffer(b"".join(words.to_pylist()), np.uint8)
        end = np.cumsum(lengths)
        text, offsets = word_bytes(data, end - lengths, end)
        word = np.repeat(np.arange(len(lengths)), np.diff(offsets))
        n1, n0 = (batch.column(i).to_numpy() for i in (1, 2))
        for _, gram, _, inside, top in _grams(text, offsets):
            rows = np.flatnonzero(inside)
            if not len(rows):
                continue
            u, inverse = np.unique(gram[rows], return_inverse=True)
            weigh = lambda n: np.bincount(inverse, weights=(n[word] * top)[rows], minlength=len(u)).astype(np.int64)
            yield pa.record_batch([pa.array(u), pa.array(weigh(n1)), pa.array(weigh(n0))], names=["gram", "n1", "n0"])


class Keyed:
    """Rows of counts by distinct integer keys: open addressing, at most half full.

    Counts are kept in the narrowest integers that hold them, so they are exact at any size.
    """

    def __init__(self, key: np.ndarray, *values: np.ndarray):
        self.key = np.append(key, -1)  # the last row is that of unknown keys: zeros
        self.values = [np.append(v, 0).astype(np.min_scalar_type(int(v.max(initial=0)))) for v in values]
        self.slot = np.full(1 << max(4, int(2 * len(key)).bit_length()), -1, np.int32)
        row, at = np.arange(len(key), dtype=np.int32), self._first(key)
        while len(row):
            free = self.slot[at] < 0
            self.slot[at[free]] = row[free]
            left = self.slot[at] != row
            row, at = row[left], (at[left] + 1) & (len(self.slot) - 1)

    def _first(self, key: np.ndarray) -> np.ndarray:
        return (mix(key.view(np.uint64)) & np.uint64(len(self.slot) - 1)).astype(np.int64)

    def find(self, key: np.ndarray) -> list[np.ndarray]:
        """The values of each key; zeros where it is unknown."""
        at = self._first(key)
        row = self.slot[at]
        open_ = np.flatnonzero((row >= 0) & (self.key[row] != key))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.slot) - 1)
            row[open_] = self.slot[at[open_]]
            open_ = open_[(row[open_] >= 0) & (self.key[row[open_]] != key[open_])]
        return [v[row] for v in self.values]


@dataclass
class Model:
    """Counts by n-gram: of the highest order for each class, of lower orders for both."""

    top: Keyed  # n-gram: occurrences in toxic, in ordinary documents
    top_context: Keyed  # context: occurrences after it by class, distinct bytes after it by class
    follow: Keyed  # lower n-gram: distinct bytes before it
    follow_context: Keyed  # context: sum of those after it, distinct bytes after it
    memo: tuple[np.ndarray, np.ndarray] | None = None  # hash and evidence of words met by this worker

    def evidence(self, text: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Per word: log-likelihood as toxic less log-likelihood as ordinary."""
        lower = np.full(len(text), 1 / 256)
        score = np.zeros(len(text))
        for k, gram, context, inside, top in _grams(text, offsets):
            if top.any():
                p = []
                counts, after = self.top.find(gram[top]), self.top_context.find(context[top])
                for label in (0, 1):  # toxic, ordinary
                    seen, kinds = after[label], after[2 + label]
                    own = np.maximum(counts[label] - DISCOUNT, 0)
                    p.append(np.where(seen > 0, (own + DISCOUNT * kinds * lower[top]) / np.maximum(seen, 1), lower[top]))
                score[top] = np.log(np.maximum(p[0], 1e-12)) - np.log(np.maximum(p[1], 1e-12))
            if k == ORDER:
                break
            (count,), (seen, kinds) = self.follow.find(gram[inside]), self.follow_context.find(context[inside])
            p = (np.maximum(count - DISCOUNT, 0) + DISCOUNT * kinds * lower[inside]) / np.maximum(seen, 1)
            lower[inside] = np.where(seen > 0, p, lower[inside])
        return np.add.reduceat(score, offsets[:-1]) if len(offsets) > 1 else np.zeros(0)

    def evidence_of_words(self, data: np.ndarray, words: Spans, first: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Evidence of distinct words; those met in an earlier slice are not spelled out again."""
        if self.memo is None:
            self.memo = np.zeros(MEMO_PLACES, np.uint64), np.full(MEMO_PLACES, np.nan)
        held, value = self.memo
        at = (hashes & np.uint64(MEMO_PLACES - 1)).astype(np.int64)
        each = np.where(held[at] == hashes, value[at], np.nan)
        new = np.flatnonzero(np.isnan(each))
        if len(new):
            each[new] = self.evidence(*word_bytes(data, words.start[first[new]], words.end[first[new]]))
            held[at[new]], value[at[new]] = hashes[new], each[new]
        return each

    def features(self, s: Slice) -> np.ndarray:
        """Features of each text of a slice; zeros without letters."""
        out = np.zeros((s.n, FEATURES))
        words = s.runs(IS_LETTER)
        if not len(words):
            return out
        first, hashes, inverse = distinct_words(words)
        size = (words.end - words.start + 1)[first].astype(float)
        each = self.evidence_of_words(s.data, words, first, hashes)
        doc, n = words.doc, s.n
        out[:, 0] = np.bincount(doc, each[inverse], n) / np.maximum(np.bincount(doc, size[inverse], n), 1)
        # a word counts once per document from here on
        pair = np.unique(doc * len(first) + inverse)
        doc, word = pair // len(first), pair % len(first)
        each, size = each[word], size[word]
        kinds = np.bincount(doc, minlength=n)
        has = np.flatnonzero(kinds)
        begin = (np.cumsum(kinds) - kinds)[has]
        top = np.minimum(kinds[has], TOP_WORDS)
        for col, value in ((1, each), (3, each / size)):
            ranked = value[np.lexsort((-value, doc))]
            total = np.concatenate([[0], np.cumsum(ranked)])
            out[has, col] = ranked[begin]
            out[has, col + 1] = (total[begin + top] - total[begin]) / TOP_WORDS
        root = np.sqrt(np.maximum(kinds, 1))
        for col, least in ((5, 2), (6, 4)):
            out[:, col] = np.bincount(doc, np.maximum(each - least, 0), n) / root
        out[:, 7] = np.bincount(doc, each, n) / np.maximum(np.bincount(doc, size, n), 1)
        out[:, 8] = np.log(np.maximum(kinds, 1))
        return out


@dataclass
class Trained:
    """The broadcast model, sent once, and the regression on its features."""

    shared: Broadcast
    logistic: Logistic


def _tables(grams: DataFrame) -> Model:
    """The model's tables from the n-grams: one row per distinct n-gram or context comes back."""
    k, body = f"shiftright(gram, {LENGTH_AT})", f"(gram & {(1 << LENGTH_AT) - 1})"
    shorter = f"shiftleft({k} - 1, {LENGTH_AT})"
    context = F.when(F.expr(f"{k} > 1"), F.expr(f"{shorter} | shiftright({body}, 8)")).otherwise(F.lit(0)).cast("bigint").alias("context")
    suffix = F.expr(f"{shorter} | ({body} & (shiftleft(1L, CAST(8 * ({k} - 1) AS INT)) - 1))").alias("gram")
    top = grams.filter("n1 + n0 > 0")
    after_top = top.select(context, "n1", "n0").groupBy("context").agg(
        F.sum("n1").alias("a"), F.sum("n0").alias("b"), F.count_if(F.col("n1") > 0).alias("c"), F.count_if(F.col("n0") > 0).alias("d"))
    # continuation counts: an n-gram of order k + 1 is one byte that precedes its suffix
    seen = grams.filter(F.expr(f"{k} > 1")).select(suffix).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    lower = grams.filter(F.expr(f"{k} < {ORDER}")).select("gram", context).join(seen, "gram", "left").withColumn("n", F.coalesce("n", F.lit(1)))
    after = lower.groupBy("context").agg(F.sum("n").alias("a"), F.count(F.lit(1)).alias("b"))

    def keyed(df: DataFrame, key: str, *values: str) -> Keyed:
        t = df.select(key, *[F.col(c).cast("bigint") for c in values]).toArrow()
        return Keyed(t[key].to_numpy(), *[t[c].to_numpy() for c in values])

    return Model(keyed(top, "gram", "n1", "n0"), keyed(after_top, "context", *"abcd"), keyed(lower, "gram", "n"), keyed(after, "context", *"ab"))


def _features(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column(0), SLICE_BYTES):
                x = model.value.features(s)
                flat = pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), FEATURES).cast(pa.list_(pa.float64()))
                yield pa.record_batch([flat, *[batch.column(i).slice(s.first, s.n) for i in (1, 2)]], names=["x", "y", "doc_id"])

    return run


def train(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> Trained:
    """Fit the two models and the regression on the labelled documents outside fold 0."""
    target = labelled(labels, "toxic")
    target = target.filter(~calibration_part(target)).select("doc_id", F.col("y").alias("toxic"))
    # texts without a label in these folds are sieved out before the join shuffles them
    known = sieve(docs.select("doc_id", "text"), target, scratch).join(target.hint("shuffle_merge"), "doc_id")
    words = known.select("text", "toxic").mapInArrow(tidy(_count_words), "word binary, n1 bigint, n0 bigint")
    words = words.groupBy("word").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    grams = words.mapInArrow(tidy(_count_grams), "gram bigint, n1 bigint, n0 bigint")
    grams = grams.groupBy("gram").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    model = _tables(scratch.table(grams, "grams"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fit_on = sample(docs, labels, "toxic", 0, FIT_DOCS)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = fit_on.select("text", "y", "doc_id").mapInArrow(tidy(_features(shared)), f"x array<double>, y int, doc_id {id_type}").toArrow().sort_by("doc_id")
    x = np.array(rows["x"].to_pylist()).reshape(-1, FEATURES)
    return Trained(shared, fit_logistic(x, rows["y"].to_numpy()))


def score(docs: DataFrame, model: Trained, into: str = "toxicity") -> DataFrame:
    """All columns of ``docs`` and ``into``, the probability that the label is 1."""
    shared, logistic = model.shared, model.logistic
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column(at), SLICE_BYTES):
                p = logistic.predict(shared.value.features(s))
                yield pa.RecordBatch.from_arrays([*batch.slice(s.first, s.n).columns, pa.array(p)], names=[*batch.schema.names, into])

    return docs.mapInArrow(tidy(run), T.StructType([*docs.schema.fields, T.StructField(into, T.DoubleType())]))


def accept(docs: DataFrame, labels: DataFrame, scratch: Scratch, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose probability of being toxic is below ``threshold``."""
    (name,) = free_names(docs.columns, "toxicity")
    return score(docs, train(docs, labels, scratch), name).filter(F.col(name) < threshold).drop(name)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train(docs, labels, Scratch(spark, "toxicity"))
    scored = score(docs, model)
    return scored.select("doc_id", (fold() == 0).alias("held_out"), F.col("toxicity").alias("score"),
                         F.when(F.col("toxicity") >= 0.5, 1).otherwise(0).alias("predicted"))
