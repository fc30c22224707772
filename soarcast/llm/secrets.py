"""Secret scans that link the parts of a credential.

Base spans are strong on their own: ``assign`` and ``hex`` are secrets, ``access`` is an access
identifier. Further candidates are weak: identifiers (names of accounts, clients, keys),
secrets (assigned values too short for the base rule, and mixed high-entropy strings) and
endpoints (addresses with a scheme, hosts with a port, assigned hosts). Within a text the three
kinds of parts are joined on their intervals: two parts are in one scope when at most
``SCOPE`` code points lie between them. A weak candidate is reported only when complementary
parts are in its scope: a secret needs an identifier or an endpoint, an identifier needs a
secret, an endpoint needs both. A weak candidate that overlaps a base span is left out.

The interval join sorts each text's parts by position and looks its range up in running
counts, so a text with very many parts costs no more than sorting them. Spans are in code
points, end exclusive. Defined results: null and empty texts have no spans; repeated rows are
scanned each for itself; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from math import log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch

SCOPE = 200
#: base kinds in the order of the contract, then the weak ones
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
BASE = KINDS[:3]
LEAST_VALUE, LEAST_WEAK_VALUE, LEAST_ENTROPY = 12, 6, 3.5

# fixed patterns of the contract; a run of 16 or more is a run that the length test keeps
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")

_MIXED = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
_IDENTIFIER = re.compile(
    r"""(?:access_?key(?:_?id)?|client_?id|account(?:_?id)?|user(?:_?name)?|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@+-]{3,})""", re.I | re.A)
_URL = re.compile(
    r"""[a-z][a-z0-9+.-]{1,20}://[^\s"'<>]+|(?:host|endpoint|server|url)["']?\x20*[:=]\x20*["']?([A-Za-z0-9.-]+\.[a-z]{2,})""", re.A)
# every dotted name as a whole, so that no part of it is tried again; group 1 is its port
_NAME = re.compile(r"[A-Za-z0-9-]++(?:(?:\.[A-Za-z0-9-]++)++(:[0-9]{2,5}\b)?)?", re.A)


def _endpoints(text: str) -> list[tuple[int, int]]:
    """URLs, values of host settings, and dotted names with a port: leftmost, without overlaps."""

    def with_port(at: int) -> re.Match | None:
        return next((m for m in _NAME.finditer(text, at) if m.group(1)), None)

    out, url, name = [], _URL.search(text), with_port(0)
    while url or name:
        m = url if name is None or url and url.start() <= name.start() else name
        out.append(m.span())
        if url and url.start() < m.end():
            url = _URL.search(text, m.end())
        if name and name.start() < m.end():
            name = with_port(m.end())
    return out


def _entropy(text: str) -> float:
    n = len(text)
    return -sum(c / n * log2(c / n) for c in Counter(text).values())


def _looks_random(text: str) -> bool:
    return bool(re.search("[0-9]", text) and re.search("[a-z]", text) and re.search("[A-Z]", text)) and _entropy(text) >= LEAST_ENTROPY


class _Places:
    """Sorted intervals of one kind of part; how many lie within ``SCOPE`` of a span."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts, self.ends = sorted(s for s, _ in spans), sorted(e for _, e in spans)

    def near(self, start: int, end: int) -> int:
        """All parts, less those that end too early and those that start too late."""
        too_early = bisect_left(self.ends, start - SCOPE)
        too_late = len(self.starts) - bisect_right(self.starts, end + SCOPE)
        return len(self.starts) - too_early - too_late


def scan(text: str) -> list[tuple[str, int, int, bool]]:
    """Spans ``(kind, start, end, weak)`` of one text, by start, then kind."""
    base, weak_secrets = [], []
    for m in _ASSIGN.finditer(text):
        value = m.end(2) - m.start(2)
        if value >= LEAST_VALUE:
            base.append(("assign", m.start(), m.end(), False))
        elif value >= LEAST_WEAK_VALUE:
            weak_secrets.append((m.start(), m.end()))
    base += [("access", m.start(), m.end(), False) for m in _ACCESS.finditer(text)]
    base += [("hex", m.start(), m.end(), False) for m in _HEX.finditer(text)]
    weak_secrets += [m.span() for m in _MIXED.finditer(text) if _looks_random(m.group())]
    found = list(base)
    if weak_secrets or any(kind != "access" for kind, *_ in base):  # without a secret nothing is linked
        taken = _merge([(s, e) for _, s, e, _ in base])
        free = lambda spans: _distinct([x for x in spans if not _overlaps(taken, *x)])
        weak = {
            "identifier": free([m.span() for m in _IDENTIFIER.finditer(text)]),
            "secret": free(weak_secrets),
            "endpoint": free(_endpoints(text)),
        }
        secrets = _Places(weak["secret"] + [(s, e) for k, s, e, _ in base if k != "access"])
        identifiers = _Places(weak["identifier"] + [(s, e) for k, s, e, _ in base if k == "access"])
        endpoints = _Places(weak["endpoint"])
        linked = {
            "identifier": lambda s, e: secrets.near(s, e),
            "secret": lambda s, e: identifiers.near(s, e) or endpoints.near(s, e),
            "endpoint": lambda s, e: secrets.near(s, e) and identifiers.near(s, e),
        }
        found += [(kind, s, e, True) for kind, spans in weak.items() for s, e in spans if linked[kind](s, e)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _overlaps(taken: list[tuple[int, int]], start: int, end: int) -> bool:
    at = bisect_left(taken, (end, -1))
    return at > 0 and taken[at - 1][1] > start


def _distinct(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans by start without those that overlap an earlier one."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if not out or s >= out[-1][1]:
            out.append((s, e))
    return out


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("weak", pa.bool_())])


def find(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans``: an array of ``kind, start, end, weak`` for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                spans = [[dict(zip(("kind", "start", "end", "weak"), x)) for x in scan(t)] if t else [] for t in part.column(1).to_pylist()]
                yield pa.record_batch([part.column(0), pa.array(spans, pa.list_(_SPAN))], names=["doc_id", "spans"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, spans array<struct<kind:string,start:bigint,end:bigint,weak:boolean>>")


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    Scratch(spark, "secrets")  # for the workers' import path
    found = find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = F.filter("spans", lambda x: ~x["weak"])
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
