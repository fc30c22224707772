"""Token ids of whole texts with a public byte-level BPE vocabulary, piece by piece.

A byte-level BPE encodes each pre-token by itself, so a text cut where its pre-tokenizer cuts
for certain gives the same ids, and a piece that was seen before need not be encoded again.
Certain cuts are: around the vocabulary's added tokens; where white space follows a character that is not white space; between ASCII
letters, digits and signs (the apostrophe of contractions aside); after a single newline
between two such characters. Everything else stays in one piece with its neighbours. Pieces
are found and hashed with numpy; a worker remembers the ids of about ``CACHE_PIECES`` pieces
by their 64-bit hash, ``CACHE_IDS`` ids at most, and takes ``ENCODE_BYTES`` of text at a time.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

from .text import IS_DIGIT, Slice, Spans

CACHE_PIECES = 2 << 20
#: ids of all remembered pieces; text without spaces gives pieces of many ids
CACHE_IDS = 16 << 20
#: slices of texts that go to the encoder: its arrays take some fifty bytes for each byte
ENCODE_BYTES = 1 << 18
#: pieces that go to the tokenizer as one string
JOINED = 64
#: strings that go to the tokenizer in one call; it holds some hundred bytes for each of their tokens
AT_ONCE = 4096
#: the id that ends every document
END_ID = 0

_BYTE = np.arange(256)
_ASCII_SPACE = (_BYTE <= 0x20) | (_BYTE == 0x7F)
# 0: none of these; 1: letter, 2: digit, 3: printable sign but the apostrophe
_KIND = np.where(((_BYTE | 32) >= 97) & ((_BYTE | 32) <= 122) & (_BYTE < 128), 1, np.where(IS_DIGIT, 2, np.where((_BYTE > 0x20) & (_BYTE < 0x7F), 3, 0)))
_KIND[ord("'")] = 0
_KIND = _KIND.astype(np.uint8)
_PRINTABLE = (_BYTE > 0x20) & (_BYTE < 0x7F)
#: first bytes of two-byte characters from U+00C0: none of them is white space
_LATIN = (_BYTE >= 0xC3) & (_BYTE <= 0xDF)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def added_tokens(tokenizer) -> re.Pattern | None:
    """Bytes of the vocabulary's added tokens, which are cut out of a text before anything else."""
    added = tokenizer.get_added_tokens_decoder().values()
    if any(t.single_word or t.lstrip or t.rstrip for t in added):
        raise ValueError("added tokens that look at their surroundings are not supported")
    contents = sorted((t.content.encode() for t in added), key=len, reverse=True)
    return re.compile(b"|".join(map(re.escape, contents))) if contents else None


def pieces(s: Slice, added: re.Pattern | None = None) -> Spans:
    """Cut the texts of a slice at added tokens, and where the pre-tokenizer cuts for certain."""
    data = s.data
    n = len(data)
    if not n:
        return Spans(s, np.zeros(0, np.int64), np.zeros(0, np.int64))
    cut = np.zeros(n + 1, bool)
    starts = np.zeros(n, bool)
    starts[s.offsets[:-1][s.offsets[:-1] < n]] = True
    opens = _PRINTABLE[data] | _LATIN[data]  # a character begins here that is not white space
    solid = _PRINTABLE[data]  # a character ends here that is not white space
    solid[1:] |= _LATIN[data[:-1]]
    kind = _KIND[data]
    space = _ASCII_SPACE[data]
    cut[1:n] |= space[1:] & solid[:-1]
    cut[1:n] |= (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
    newline = data == 10
    alone = newline & starts
    alone[1:] |= newline[1:] & solid[:-1] & ~starts[1:]
    cut[1:n] |= opens[1:] & alone[:-1]
    if added:
        for m in added.finditer(data.tobytes()):
            if not starts[m.start() + 1 : m.end()].any():  # within one text
                cut[m.start() + 1 : m.end()] = False
                cut[[m.start(), m.end()]] = True
    cut[:n] |= starts
    cut[n] = True
    at = np.flatnonzero(cut)
    return Spans(s, at[:-1], at[1:])


def _with_room(values: np.ndarray, used: int, more: int) -> np.ndarray:
    """``values`` with room for ``more`` behind the first ``used``. Room that is not written yet costs no memory."""
    if used + more <= len(values):
        return values
    grown = np.empty(used + max(used // 2, more), values.dtype)
    grown[:used] = values[:used]
    return grown


class Encoder:
    """Slices of texts to ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = added_tokens(self.tokenizer)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        # a byte-level token has one character for each of its bytes
        self.bytes_of = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        self.bytes_of[list(vocabulary.values())] = [len(token) for token in vocabulary]
        self.joins = not self.added or b" " not in self.added.pattern
        self.id_type = np.uint16 if len(self.bytes_of) <= 1 << 16 else np.uint32
        self._forget()

    def _forget(self) -> None:
        # sorted hashes with the number of each piece, in runs of falling size (merged like a log)
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []
        # ids of all pieces by number, and where each begins (one more at the end)
        self.known, self.used = 0, 0
        self.start, self.ids = np.zeros(1, np.uint32), np.zeros(0, self.id_type)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of sorted ``hashes``; -1 for pieces that are not known."""
        at = np.full(len(hashes), -1, np.int64)
        for known, number in self.runs:
            todo = np.flatnonzero(at < 0)
            place = np.minimum(np.searchsorted(known, hashes[todo]), len(known) - 1)
            hit = known[place] == hashes[todo]
            at[todo[hit]] = number[place[hit]]
        return at

    def _encoded(self, strings: list[bytes], at_once: int) -> Iterator[list[int]]:
        for i in range(0, len(strings), at_once):
            for e in self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in strings[i : i + at_once]], add_special_tokens=False):
                yield e.ids

    def _one_by_one(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after another, and how many each has."""
        flat, length = array("I"), []
        for ids in self._encoded(texts, AT_ONCE):
            length.append(len(ids))
            flat.extend(ids)
        return np.frombuffer(flat, np.uint32), np.array(length, np.int64)

    def _joined(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same for pieces that begin with a space and end in a printable ASCII character.

        The pre-tokenizer cuts between two such pieces, so they are encoded as one string. The bytes
        of its tokens tell where each piece ends; where they do not, it is one by one.
        """
        flat = array("I")
        for ids in self._encoded([b"".join(texts[i : i + JOINED]) for i in range(0, len(texts), JOINED)], AT_ONCE // JOINED):
            flat.extend(ids)
        ids = np.frombuffer(flat, np.uint32)
        end = np.cumsum(self.bytes_of[ids])
        want = np.cumsum([len(t) for t in texts])
        last = np.searchsorted(end, want)
        if not len(ids) or end[-1] != want[-1] or (end[last] != want).any():
            return self._one_by_one(texts)
        return ids, np.diff(last + 1, prepend=0)

    def _learn(self, hashes: np.ndarray, texts: list[bytes]) -> np.ndarray:
        """Remember pieces that are new, ``hashes`` sorted; their numbers."""
        spaced = np.array([self.joins and t[0] == 0x20 and 0x20 < t[-1] < 0x7F for t in texts], bool)
        parts = [(rows, *encode([texts[i] for i in rows.tolist()])) for encode, rows in
                 ((self._joined, np.flatnonzero(spaced)), (self._one_by_one, np.flatnonzero(~spaced))) if len(rows)]
        order, flat, length = (np.concatenate(x) for x in zip(*parts))
        number = np.empty(len(texts), np.int32)
        number[order] = np.arange(self.known, self.known + len(texts))
        self.runs.append((hashes, number))
        while len(self.runs) > 1 and len(self.runs[-2][0]) < 2 * len(self.runs[-1][0]):
            both = [np.concatenate(x) for x in zip(self.runs.pop(), self.runs.pop())]
            order = np.argsort(both[0], kind="stable")
            self.runs.append((both[0][order], both[1][order]))
        self.start = _with_room(self.start, self.known + 1, len(texts))
        self.start[self.known + 1 : self.known + 1 + len(texts)] = self.used + np.cumsum(length)
        self.ids = _with_room(self.ids, self.used, len(flat))
        self.ids[self.used : self.used + len(flat)] = flat
        self.known, self.used = self.known + len(texts), self.used + len(flat)
        return number

    def _lengths(self, at: np.ndarray) -> np.ndarray:
        return self.start[at + 1].astype(np.int64) - self.start[at]

    def count(self, s: Slice) -> int:
        """Number of ids of the slice's texts."""
        at = self._numbers(pieces(s, self.added))[0]
        return int(self._lengths(at).sum())

    def _numbers(self, cut: Spans) -> tuple[np.ndarray, Spans]:
        """Number of each piece, after those that were not known are encoded."""
        s = cut.of
        if not len(cut):
            return np.zeros(0, np.int64), cut
        kinds, first, inverse = np.unique(cut.hashes(), return_index=True, return_inverse=True)
        if self.known > CACHE_PIECES or self.used > CACHE_IDS:
            self._forget()
        at = self._find(kinds)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            raw = s.data.tobytes()
            texts = [raw[a:b] for a, b in zip(cut.start[first[missing]].tolist(), cut.end[first[missing]].tolist())]
            at[missing] = self._learn(kinds[missing], texts)
        return at[inverse], cut

    def encode(self, s: Slice) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the slice's texts, and where each text's ids begin (one more at the end)."""
        at, cut = self._numbers(pieces(s, self.added))
        if not len(cut):
            return np.zeros(0, np.uint32), np.zeros(s.n + 1, np.int64)
        length = self._lengths(at)
        end = np.cumsum(length)
        ids = self.ids[np.repeat(self.start[at] - (end - length), length) + np.arange(end[-1])].astype(np.uint32)
        per_text = np.bincount(cut.doc, length, s.n).astype(np.int64)
        return ids, np.concatenate([[0], np.cumsum(per_text)])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's encoder; worker processes are reused across tasks, and so is its memory."""
    return Encoder(path)
