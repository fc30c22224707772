"""Quality classifier on random-indexing word vectors, pooled per document.

Tokens are runs of letters, of digits or of other signs. Every token has a sparse random index
vector (``NONZERO`` entries of +1 or -1 among ``DIM``), drawn from its hash; the context vector
of a token is the sum of the index vectors of its neighbours within ``REACH`` tokens, over all
documents. Every distinct token (by a 64-bit hash) has a row of its own. Tasks add up the contexts
of the tokens they meet and shuffle them by token, packed; a token's vector is the signs of its
sum, one bit each (an entry of zero takes a bit of the token's hash), so it does not depend on the
order of tasks.

A document is the mean of its tokens' vectors, with the number of its tokens and the share of
distinct ones. The most frequent tokens, at most ``HOT_WORDS`` (12 bytes each), are broadcast and
pooled where a text is read; all others, none of which can be a hot key, are joined to the table of
vectors and added by document. Where the frequent ones end changes no result. A network of two
layers, trained on at most ``TRAIN_DOCS`` labelled ids, gives a logit whose temperature is fitted
on at most ``CALIBRATE_DOCS`` others.

Defined results: texts without tokens (null, empty, white space only) have the zero vector
and get its score; tokens without a vector add nothing to the mean; repeated rows are scored each
for itself; with fewer than two labelled ids of a class every score is the share of good rows (0
with no labels at all); an empty table gives an empty result.
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

from .labels import fold, sample
from .logistic import sigmoid
from .scratch import Scratch
from .text import IS_DIGIT, IS_LETTER, IS_SPACE, Slice, Spans, slices

DIM, NONZERO, REACH = 32, 4, 2
#: tokens whose vectors are broadcast, and tokens that a task holds before it hands their sums on
HOT_WORDS, HELD_WORDS = 1 << 18, 1 << 18
#: bits of an entry of a packed context vector; what fits none of them takes 64
ENTRY_BITS = (2, 4, 8)
TRAIN_DOCS, CALIBRATE_DOCS = 20_000, 10_000
HIDDEN, EPOCHS, BATCH, RATE, SEED = 32, 40, 256, 3e-3, 7
THRESHOLD = 0.3
#: features of a document
WIDTH = DIM + 2
_CLASS = np.where(IS_SPACE, 0, np.where(IS_LETTER, 1, np.where(IS_DIGIT, 2, 3))).astype(np.uint8)


def tokens(s: Slice) -> Spans:
    """Maximal runs of letters, digits or other signs within a text."""
    kind = _CLASS[s.data]
    edge = np.ones(len(kind) + 1, bool)
    if len(kind):
        edge[1:-1] = kind[1:] != kind[:-1]
        edge[s.offsets] = True
    at = np.flatnonzero(edge)
    start, end = at[:-1], at[1:]
    full = kind[start] > 0 if len(kind) else np.zeros(0, bool)
    return Spans(s, start[full], end[full])


def contexts(s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct tokens (hashes), their numbers and their context vectors."""
    words = tokens(s)
    u, inverse, n = np.unique(words.hashes(), return_inverse=True, return_counts=True)
    table = np.zeros(len(u) * DIM)
    doc, h, row = words.doc, words.hashes(), inverse * DIM
    for i in range(NONZERO):
        place = ((h >> np.uint64(5 * i)) & np.uint64(DIM - 1)).astype(np.int64)
        sign = 1 - 2 * ((h >> np.uint64(40 + i)) & np.uint64(1)).astype(np.int64)
        for step in range(1, min(REACH, len(h) - 1) + 1):
            same = doc[step:] == doc[:-step]
            for to, of in ((row[:-step], slice(step, None)), (row[step:], slice(None, -step))):
                table += np.bincount(to[same] + place[of][same], sign[of][same], len(table))
    return u, n, table.reshape(-1, DIM).astype(np.int64)


def _add_up(u: np.ndarray, n: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One row per distinct token, in order."""
    if not len(u):
        return u, n, table
    order = np.argsort(u, kind="stable")
    u = u[order]
    first = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]]))
    return u[first], np.add.reduceat(n[order], first), np.add.reduceat(table[order], first, axis=0)


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of bytes, all of one length, as an Arrow column."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def pack(table: np.ndarray) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """Rows of integers as bytes, in the fewest bits an entry that hold a row; with the rows' numbers."""
    most = np.abs(table).max(axis=1, initial=0)
    done = np.zeros(len(table), bool)
    for bits in ENTRY_BITS:
        top = (1 << (bits - 1)) - 1
        rows = np.flatnonzero(~done & (most <= top))
        done[rows] = True
        entry = (table[rows] + top).astype(np.uint8).reshape(len(rows), DIM * bits // 8, 8 // bits)
        shift = (np.arange(8 // bits) * bits).astype(np.uint8)
        yield rows, _binary(np.bitwise_or.reduce(entry << shift, axis=2))
    rows = np.flatnonzero(~done)
    yield rows, _binary(table[rows].astype("<i8").view(np.uint8).reshape(len(rows), 8 * DIM))


def unpack(packed: pa.Array) -> np.ndarray:
    """The rows of ``pack``, told by their lengths."""
    length = pc.binary_length(packed).to_numpy(zero_copy_only=False)
    out = np.zeros((len(length), DIM), np.int64)
    for size in np.unique(length):
        rows = np.flatnonzero(length == size)
        data = np.frombuffer(b"".join(packed.take(pa.array(rows)).to_pylist()), np.uint8).reshape(len(rows), size)
        bits = int(size) * 8 // DIM
        if bits == 64:
            out[rows] = data.copy().view("<i8")
            continue
        shift = (np.arange(8 // bits) * bits).astype(np.uint8)
        entry = (data[:, :, None] >> shift) & np.uint8((1 << bits) - 1)
        out[rows] = entry.reshape(len(rows), DIM).astype(np.int64) - ((1 << (bits - 1)) - 1)
    return out


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed sums of this task's tokens; handed on whenever many are held."""

    def rows(u, n, table):
        for some, sums in pack(table):
            if len(some):
                yield pa.record_batch([pa.array(u[some].view(np.int64)), pa.array(n[some].astype(np.int64)), sums], names=["token", "n", "sums"])

    none = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros((0, DIM), np.int64))
    held, fresh = none, []
    for batch in batches:
        for s in slices(batch.column(0)):
            fresh.append(contexts(s))
            if sum(len(x[0]) for x in fresh) + len(held[0]) >= HELD_WORDS:
                held, fresh = _add_up(*[np.concatenate(x) for x in zip(held, *fresh)]), []
                if len(held[0]) >= HELD_WORDS // 2:
                    yield from rows(*held)
                    held = none
    yield from rows(*_add_up(*[np.concatenate(x) for x in zip(held, *fresh)]))


def signs(u: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The signs of each row as the bits of an integer; zeros take a bit of the token's hash."""
    own = (u[:, None] >> np.arange(32, 32 + DIM, dtype=np.uint64)) & np.uint64(1) == 1
    positive = np.where(table == 0, own, table > 0)
    return (positive.astype(np.uint32) << np.arange(DIM, dtype=np.uint32)).sum(axis=1, dtype=np.uint32).view(np.int32)


def _total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors from rows sorted by token: only the last token waits for the next batch."""

    def rows(u, n, table):
        return pa.record_batch([pa.array(u.view(np.int64)), pa.array(n), pa.array(signs(u, table))], names=["token", "n", "bits"])

    last = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros((0, DIM), np.int64))
    for batch in batches:
        if not batch.num_rows:
            continue
        u, n, table = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy(), unpack(batch.column(2))
        # the waiting token is first in order or equal to the first
        first = np.concatenate([[True], u[1:] != u[:-1]])
        if len(last[0]):
            first = np.concatenate([[True], [last[0][-1] != u[0]], first[1:]])
        u, n, table = (np.concatenate(x) for x in zip(last, (u, n, table)))
        at = np.flatnonzero(first)
        u, n, table = u[at], np.add.reduceat(n, at), np.add.reduceat(table, at, axis=0)
        yield rows(u[:-1], n[:-1], table[:-1])
        last = u[-1:], n[-1:], table[-1:]
    yield rows(*last)


@dataclass
class Vectors:
    """``token, n, bits`` of every token; of those with ``n >= hot_from`` also sorted in a broadcast."""

    table: DataFrame
    hot_from: int
    hot: Broadcast


def word_vectors(docs: DataFrame, scratch: Scratch) -> Vectors:
    """The vectors of all tokens of all documents."""
    parts = docs.select("text").mapInArrow(_partial, "token bigint, n bigint, sums binary")
    in_order = parts.repartition("token").sortWithinPartitions("token")
    table = scratch.table(in_order.mapInArrow(_total, "token bigint, n bigint, bits int"), "vectors")
    # tokens by sixteenths of a doubling of their number: about a thousand rows at any size
    steps = table.groupBy(F.floor(F.log2("n") * 16).alias("step")).agg(F.count(F.lit(1)).alias("tokens"), F.min("n").alias("least"))
    hot_from, room = (1 << 63) - 1, HOT_WORDS
    for row in steps.orderBy(F.desc("step")).collect():
        room -= row.tokens
        if room < 0:
            break
        hot_from = row.least
    hot = table.filter(F.col("n") >= hot_from).select("token", "bits").toArrow()
    token, bits = hot["token"].to_numpy().view(np.uint64), hot["bits"].to_numpy()
    order = np.argsort(token)
    return Vectors(table, hot_from, docs.sparkSession.sparkContext.broadcast((token[order], bits[order])))


def _lists(counts: np.ndarray, values: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def pool(s: Slice, token: np.ndarray, bits: np.ndarray) -> list[pa.Array]:
    """For each text: sums of the vectors of frequent tokens, number of tokens and of distinct
    ones, and the other tokens with their numbers."""
    words = tokens(s)
    u, inverse = np.unique(words.hashes(), return_inverse=True)
    pair, times = np.unique(words.doc * max(len(u), 1) + inverse, return_counts=True)
    doc, word = pair // max(len(u), 1), pair % max(len(u), 1)
    at = np.minimum(np.searchsorted(token, u), max(len(token) - 1, 0))
    found = token[at] == u if len(token) else np.zeros(len(u), bool)
    sums = np.zeros((s.n, DIM), np.int32)
    frequent = found[word] if len(u) else np.zeros(0, bool)
    if frequent.any():
        sign = np.zeros((len(u), DIM), np.int32)
        sign[found] = 2 * ((bits[at[found]].view(np.uint32)[:, None] >> np.arange(DIM, dtype=np.uint32)) & 1).astype(np.int32) - 1
        of = doc[frequent]
        first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        sums[of[first]] = np.add.reduceat(sign[word[frequent]] * times[frequent, None].astype(np.int32), first, axis=0)
    rare = ~frequent
    rare_counts = np.bincount(doc[rare], minlength=s.n)
    return [
        pa.FixedSizeListArray.from_arrays(pa.array(sums.reshape(-1)), DIM).cast(pa.list_(pa.int32())),
        pa.array(words.per_doc.astype(np.int32)), pa.array(np.bincount(doc, minlength=s.n).astype(np.int32)),
        _lists(rare_counts, u[word[rare]].view(np.int64)), _lists(rare_counts, times[rare].astype(np.int32))]


def pooled(docs: DataFrame, vectors: Vectors, scratch: Scratch, name: str) -> DataFrame:
    """The columns of ``docs`` but ``text``, and ``sums, rest`` (arrays of ``DIM``), ``n, kinds``.

    ``rest`` holds the sums of the tokens that came through the join, null without any.
    """
    hot, keep = vectors.hot, [f for f in docs.schema.fields if f.name != "text"]
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column(at)):
                kept = [batch.column(i).slice(s.first, s.n) for i in range(batch.num_columns) if i != at]
                yield pa.RecordBatch.from_arrays([*kept, *pool(s, *hot.value)], names=[f.name for f in schema.fields])

    own = T.StructType.fromDDL("sums array<int>, n int, kinds int, token array<bigint>, times array<int>")
    schema = T.StructType([*keep, *own.fields])
    # written, so that a row keeps its number
    rows = scratch.table(docs.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), name)
    pairs = rows.select("row", F.inline(F.arrays_zip("token", "times")))
    rare = vectors.table.filter(F.col("n") < vectors.hot_from).select("token", "bits")
    met = pairs.join(rare, "token").select("row", "bits", "times").repartition("row")
    entry = lambda d: F.sum(F.col("times") * (2 * F.shiftright("bits", d).bitwiseAND(F.lit(1)) - 1)).cast("int")
    rest = met.groupBy("row").agg(F.array(*[entry(d) for d in range(DIM)]).alias("rest"))
    return rows.drop("token", "times").join(rest, "row", "left").drop("row")


def features(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
    """Mean vector, log of the number of tokens and share of distinct ones, from ``pooled`` rows."""
    column = lambda c: batch[c].combine_chunks() if isinstance(batch, pa.Table) else batch[c]
    out = np.zeros((batch.num_rows, WIDTH))
    out[:, :DIM] = column("sums").flatten().to_numpy().reshape(-1, DIM)
    rest = column("rest")
    out[np.flatnonzero(rest.is_valid().to_numpy(zero_copy_only=False)), :DIM] += rest.flatten().to_numpy().reshape(-1, DIM)
    n, kinds = column("n").to_numpy(), column("kinds").to_numpy()
    out[:, :DIM] /= np.maximum(n, 1)[:, None]
    out[:, DIM], out[:, DIM + 1] = np.log1p(n), kinds / np.maximum(n, 1)
    return out


@dataclass
class Network:
    """Two layers on standardised features; ``temperature`` divides the logit."""

    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray] | None
    temperature: float
    base: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((x - self.mean) / self.scale @ w1 + b1) @ w2 + b2[0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.layers is None:
            return np.full(len(x), self.base)
        return sigmoid(self.logit(x) / self.temperature)


def fit_network(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Minibatch Adam on the log loss, from a fixed seed."""
    rng = np.random.default_rng(SEED)
    width = x.shape[1]
    p = [rng.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), BATCH):
            rows = order[lo : lo + BATCH]
            h = np.tanh(x[rows] @ p[0] + p[1])
            error = (sigmoid(h @ p[2] + p[3][0]) - y[rows]) / len(rows)
            back = error[:, None] * p[2] * (1 - h**2)
            gradients = [x[rows].T @ back + 1e-4 * p[0], back.sum(axis=0), h.T @ error + 1e-4 * p[2], np.array([error.sum()])]
            step += 1
            for i, g in enumerate(gradients):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                p[i] = p[i] - RATE * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return p


def fit_temperature(logit: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logit with the least log loss, by a search on a fine grid."""
    grid = np.exp(np.linspace(np.log(0.2), np.log(10), 200))
    loss = lambda t: -np.mean(np.log(np.maximum(np.where(y == 1, sigmoid(logit / t), sigmoid(-logit / t)), 1e-12)))
    return float(min(grid, key=loss))


@dataclass
class Trained:
    """Word vectors and the network on top of them."""

    vectors: Vectors
    network: Network


def train(docs: DataFrame, labels: DataFrame, scratch: Scratch, column: str = "quality") -> Trained:
    """Vectors from all documents, the network from a bounded sample outside fold 0."""
    vectors = word_vectors(docs, scratch)
    rows = sample(docs, labels, column, TRAIN_DOCS, CALIBRATE_DOCS)
    t = pooled(rows, vectors, scratch, "sampled").toArrow().sort_by("doc_id")
    y, calibrate = t["y"].to_numpy().astype(np.int64), t["calibrate"].to_numpy()
    chosen = ~calibrate
    if not chosen.any() or y[chosen].min() == y[chosen].max():
        return Trained(vectors, Network(np.zeros(WIDTH), np.ones(WIDTH), None, 1.0, float(y.mean()) if len(y) else 0.0))
    x = features(t)
    mean, scale = x[chosen].mean(axis=0), x[chosen].std(axis=0)
    net = Network(mean, np.where(scale > 1e-9, scale, 1.0), None, 1.0, float(y.mean()))
    net.layers = fit_network((x[chosen] - net.mean) / net.scale, y[chosen])
    fit_on = calibrate if calibrate.any() else chosen
    net.temperature = fit_temperature(net.logit(x[fit_on]), y[fit_on])
    return Trained(vectors, net)


def score(docs: DataFrame, model: Trained, scratch: Scratch) -> DataFrame:
    """``doc_id`` and ``quality``, the probability that the label is 1."""
    network = model.network

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array(network.probability(features(batch)))], names=["doc_id", "quality"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = pooled(docs.select("doc_id", "text"), model.vectors, scratch, "scored")
    return rows.select("doc_id", "sums", "rest", "n", "kinds").mapInArrow(run, f"doc_id {id_type}, quality double")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "quality-vectors")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), scratch), scratch)
    return scored.select("doc_id", (fold() == 0).alias("held_out"), F.col("quality").alias("score"),
                         F.when(F.col("quality") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
