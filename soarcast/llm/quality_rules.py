"""Quality rules: exact base counts, and a hashed n-gram logistic regression with a threshold.

The model sees hashed words, pairs of neighbouring words and ``CHAR_N``-byte n-grams; a text's
evidence is the mean weight of its n-grams, words and bytes apart, so length does not count.
Weights are trained on at most ``TRAIN_DOCS`` labelled rows, and a logistic calibration turns
the evidence into a probability on at most ``CALIBRATE_DOCS`` others. Scoring reads Arrow
batches in slices and looks weights up in one table of fixed size (``2**BITS`` floats, 1 MB).

Defined results: a null or empty text has no words and fails the base rule; texts without
n-grams have evidence 0; repeated rows are scored each for itself; without labels of both
classes the probability is the share of good rows (1 with no labels at all), so only the
base rule decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .labels import sample
from .logistic import Logistic, fit_logistic, sigmoid
from .scratch import Scratch
from .text import IS_SPACE, Slice, mix, slices, windows

BITS = 18
CHAR_N = 4
TRAIN_DOCS, CALIBRATE_DOCS = 3000, 3000
STEPS, RATE, DECAY = 60, 0.3, 1e-4
#: fixed thresholds: least probability of being good, least words, most repeated words in percent
KEEP_FROM, LEAST_WORDS, MOST_REPEAT_PERCENT = 0.5, 50, 50
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_LEAD = (np.arange(256) & 0xC0) != 0x80


def base_counts(s: Slice) -> dict[str, np.ndarray]:
    """The base rule's exact counts for each text of a slice."""
    n = s.n
    per_text = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[s.offsets])
    space = IS_SPACE[s.data]
    words = s.runs(~IS_SPACE)
    lines = s.lines()
    filled = np.concatenate([[0], np.cumsum(~space)])
    filled = filled[lines.end] > filled[lines.start]
    line_doc, line_hash = lines.doc[filled], lines.hashes()[filled]
    distinct = np.unique(mix(line_hash + line_doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]
    dup = np.bincount(line_doc, minlength=n) - np.bincount(line_doc[distinct], minlength=n)
    grams, first = windows(words.hashes(), words.doc, 3)
    own = mix(grams + words.doc[first].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(own, kind="stable")
    same = own[order][1:] == own[order][:-1]
    twice = np.zeros(len(own), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for i in range(3):
        covered[first[twice] + i] = True
    return {
        "n_words": words.per_doc, "word_chars": per_text(_LEAD[s.data] & ~space), "n_symbols": per_text(_SYMBOL[s.data]),
        "n_dup_lines": dup, "n_repeat_words": np.bincount(words.doc[covered], minlength=n),
    }


def ngram_cells(s: Slice) -> list[tuple[np.ndarray, np.ndarray]]:
    """Two families of n-grams, words and bytes: the text of each n-gram and its cell."""
    cell = lambda h: (h >> np.uint64(64 - BITS)).astype(np.int64)
    words = s.runs(~IS_SPACE)
    h = words.hashes()
    pair, first = windows(h, words.doc, 2)
    word_doc = np.concatenate([words.doc, words.doc[first]])
    word_cell = cell(np.concatenate([mix(h + np.uint64(11)), mix(pair + np.uint64(13))]))
    m = max(len(s.data) - CHAR_N + 1, 0)
    value = np.zeros(m, np.uint64)
    for i in range(CHAR_N):
        value = (value << np.uint64(8)) | s.data[i : i + m].astype(np.uint64)
    byte_doc = np.repeat(np.arange(s.n), np.diff(s.offsets))
    inside = byte_doc[:m] == byte_doc[CHAR_N - 1 : CHAR_N - 1 + m]
    return [(word_doc, word_cell), (byte_doc[:m][inside], cell(mix(value[inside] + np.uint64(17))))]


def _mean(doc: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(doc, value, n) / np.maximum(np.bincount(doc, minlength=n), 1)


@dataclass
class Rules:
    """Trained weights and their calibration."""

    weights: np.ndarray
    calibration: Logistic

    def evidence(self, s: Slice) -> np.ndarray:
        return sum(_mean(doc, self.weights[cell], s.n) for doc, cell in ngram_cells(s))

    def probability(self, s: Slice) -> np.ndarray:
        return self.calibration.predict(self.evidence(s)[:, None])


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's distinct cells and their shares (words and bytes sum to 1 each)."""
    for batch in batches:
        for s in slices(batch.column(0)):
            docs, cells, shares = [], [], []
            for doc, cell in ngram_cells(s):
                key, count = np.unique(doc << BITS | cell, return_counts=True)
                docs.append(key >> BITS)
                cells.append(key & ((1 << BITS) - 1))
                shares.append(count / np.maximum(np.bincount(doc, minlength=s.n), 1)[key >> BITS])
            doc, cell, share = (np.concatenate(x) for x in (docs, cells, shares))
            order = np.argsort(doc, kind="stable")
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=s.n))]).astype(np.int32))
            yield pa.record_batch(
                [pa.ListArray.from_arrays(offsets, pa.array(cell[order].astype(np.int32))),
                 pa.ListArray.from_arrays(offsets, pa.array(share[order].astype(np.float32))),
                 batch.column(1).slice(s.first, s.n), batch.column(2).slice(s.first, s.n)], names=["cells", "shares", "y", "calibrate"])


def fit_weights(doc: np.ndarray, cell: np.ndarray, share: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression on sparse rows by full-batch Adam; classes weigh alike."""
    w, m, v = (np.zeros(1 << BITS) for _ in range(3))
    bias = 0.0
    balance = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9)) / len(y)
    for step in range(1, STEPS + 1):
        z = np.bincount(doc, share * w[cell], len(y)) + bias
        error = (sigmoid(z) - y) * balance
        gradient = np.bincount(cell, share * error[doc], 1 << BITS) + DECAY * w / len(y)
        m = 0.9 * m + 0.1 * gradient
        v = 0.99 * v + 0.01 * gradient**2
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        bias -= RATE * error.sum()
    return w


def train(docs: DataFrame, labels: DataFrame, column: str = "quality") -> Rules:
    """Fit on a bounded sample of labelled rows outside fold 0."""
    # in order of ids, so that sums do not depend on the tasks; sorted before the driver holds the cells
    rows = sample(docs, labels, column, TRAIN_DOCS, CALIBRATE_DOCS).orderBy("doc_id").select("text", "y", "calibrate")
    t = rows.mapInArrow(_sparse, "cells array<int>, shares array<float>, y int, calibrate boolean").toArrow()
    y, calibrate = t["y"].to_numpy().astype(np.int64), t["calibrate"].to_numpy()
    if not len(y) or y[~calibrate].min(initial=1) == y[~calibrate].max(initial=0):
        return Rules(np.zeros(1 << BITS, np.float32), Logistic(np.zeros(1), np.ones(1), None, 0.0, float(y.mean()) if len(y) else 1.0))
    cells, shares = t["cells"].combine_chunks(), t["shares"].combine_chunks()
    del t  # these are copies
    doc = np.repeat(np.arange(len(y), dtype=np.int32), np.diff(cells.offsets.to_numpy()))
    cell, share = cells.flatten().to_numpy(), shares.flatten().to_numpy()
    chosen = ~calibrate
    number = np.cumsum(chosen, dtype=np.int32) - 1
    mine = chosen[doc]
    w = fit_weights(number[doc[mine]], cell[mine], share[mine], y[chosen])
    evidence = np.bincount(doc, share * w[cell], len(y))
    fit_on = calibrate if calibrate.any() and y[calibrate].min() != y[calibrate].max() else chosen
    return Rules(w.astype(np.float32), fit_logistic(evidence[fit_on][:, None], y[fit_on]))


def judge(docs: DataFrame, rules: Rules) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``probability`` and ``kept`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column(1)):
                c = base_counts(s)
                failed = (c["n_words"] < LEAST_WORDS) | (100 * c["n_repeat_words"] > MOST_REPEAT_PERCENT * c["n_words"])
                p = shared.value.probability(s)
                yield pa.record_batch(
                    [batch.column(0).slice(s.first, s.n), *[pa.array(x.astype(np.int64)) for x in c.values()],
                     pa.array(failed), pa.array(p), pa.array(~failed & (p >= KEEP_FROM))],
                    names=["doc_id", *c, "base_failed", "probability", "kept"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"{c} bigint" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, {counts}, base_failed boolean, probability double, kept boolean")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    Scratch(spark, "quality-rules")  # for the workers' import path
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return judge(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
