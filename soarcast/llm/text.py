"""Words and hashes of whole texts, read straight from Arrow string buffers with numpy.

An Arrow string column is one byte buffer plus offsets. The helpers here walk that buffer
in slices of about one MB (a longer text is a slice of its own), so no Python string is made
per word and memory stays bounded by the slice, not by the partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)

_BYTE = np.arange(256)
#: bytes of white space in the contracts: space, tab, newline, vertical tab, form feed, return
IS_SPACE = np.isin(_BYTE, [0x20, *range(0x09, 0x0E)])
#: letters: ASCII letters and every byte of a non-ASCII character
IS_LETTER = ((_BYTE >= 65) & (_BYTE <= 90)) | ((_BYTE >= 97) & (_BYTE <= 122)) | (_BYTE >= 128)
IS_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
#: A-Z to a-z, all else unchanged
LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (splitmix64), so that every bit depends on every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for i < n; kept per process, grown by need."""
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"][:n], _POWERS["down"][:n]


@dataclass
class Slice:
    """Some consecutive texts: their bytes, and where each begins (``offsets`` has one more)."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def runs(self, member: np.ndarray) -> Spans:
        """Maximal runs of bytes for which ``member`` (a table of 256) holds, within a text."""
        inside = member[self.data]
        prev = np.empty_like(inside)
        prev[1:] = inside[:-1]
        prev[self.offsets[:-1][self.offsets[:-1] < len(prev)]] = False
        if len(prev):
            prev[0] = False
        start = np.flatnonzero(inside & ~prev)
        after = np.empty_like(inside)
        after[:-1] = inside[1:]
        last = self.offsets[1:] - 1
        after[last[last >= 0]] = False
        end = np.flatnonzero(inside & ~after) + 1
        return Spans(self, start, end)

    def lines(self) -> Spans:
        """Pieces between newlines, the newline left out; a text always has at least one."""
        at = np.flatnonzero(self.data == 10)
        lo = np.concatenate([self.offsets[:-1], at + 1])
        hi = np.concatenate([self.offsets[1:], at])
        # a text that ends where the next begins shares that offset: order by document first
        doc_lo = np.concatenate([np.arange(self.n), np.searchsorted(self.offsets, at, side="right") - 1])
        order = np.lexsort((lo, doc_lo))
        order_hi = np.lexsort((hi, doc_lo))
        return Spans(self, lo[order], hi[order_hi], doc_lo[order])


@dataclass
class Spans:
    """Byte spans of a slice, in order; ``doc`` is the index of the text each lies in."""

    of: Slice
    start: np.ndarray
    end: np.ndarray
    _doc: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.start)

    @cached_property
    def doc(self) -> np.ndarray:
        if self._doc is not None:
            return self._doc
        return np.searchsorted(self.of.offsets, self.start, side="right") - 1

    @cached_property
    def per_doc(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.of.n)

    def hashes(self, table: np.ndarray | None = None) -> np.ndarray:
        """64-bit hash of each span's bytes; ``table`` maps bytes first (``LOWER``)."""
        data = self.of.data if table is None else table[self.of.data]
        up, down = _powers(len(data) + 1)
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUE[data] * up[: len(data)], out=total[1:])
        raw = (total[self.end] - total[self.start]) * down[self.start]
        return mix(raw + (self.end - self.start).astype(np.uint64))


def slices(texts: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a string column into slices of at most ``limit`` bytes (or one text). Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.large_string())
    texts = texts.cast(pa.large_string()) if texts.type != pa.large_string() else texts
    n = len(texts)
    if not n:
        return
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[texts.offset : texts.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    if texts.null_count:
        # a null may keep bytes under it: rebuild with empty texts in their place
        texts = pa.array(["" if x is None else x for x in texts.to_pylist()], pa.large_string())
        yield from slices(texts, limit)
        return
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        begin, end = int(offsets[lo]), int(offsets[hi])
        yield Slice(lo, raw[begin:end], offsets[lo : hi + 1] - begin)
        lo = hi


def windows(values: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every ``k`` consecutive values of the same text, and the index of the first."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        h = mix(h + values[i : i + n] + np.uint64(i + 1)) if i else mix(values[:n] + np.uint64(k << 8))
    first = np.flatnonzero(doc[:n] == doc[k - 1 : k - 1 + n])
    return h[first], first


def short_sequences(values: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of texts with 1 to k-1 values: the text and one hash for its whole sequence."""
    first = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    docs, out = [], []
    for m in range(1, k):
        d = np.flatnonzero(counts == m)
        if not len(d):
            continue
        h = mix(values[first[d]] + np.uint64(m << 8))
        for i in range(1, m):
            h = mix(h + values[first[d] + i] + np.uint64(i + 1))
        docs.append(d)
        out.append(h)
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(docs), np.concatenate(out)
