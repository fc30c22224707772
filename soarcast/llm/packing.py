"""Bounded-space online packing of documents into sequences of ``SEQ_TOKENS`` tokens.

Each partition reads its documents once, in order, and keeps at most ``open_windows`` open
sequences. A document's whole chunks of ``SEQ_TOKENS`` are sequences of their own; what is
left is placed best-fit, in the fullest window with room for it. When none fits, the fullest
window is emitted: if its gap is worth a cut (``MIN_CUT`` tokens or more) the head of the
document fills it first, else the gap becomes padding. What each partition leaves open is
written with the rest and merged afterwards, window by window, best-fit by falling size, in
groups of ``MERGE_PARTITIONS`` partitions, so no task ever holds more than
``MERGE_PARTITIONS * open_windows`` windows.

Pieces are written once to the shared folder before the merge, so a lost executor cannot
mix two different packings of one partition. Defined results: a null or empty text is one
piece with the end token alone; repeated rows are packed each for itself; ids may be null
or repeat; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import Scratch
from .text import slices
from .tokens import ENCODE_BYTES, END_ID, default_tokenizer, encoder
from .workers import tidy

SEQ_TOKENS = 1024
OPEN_WINDOWS = 64
#: a gap below this many tokens is padded, not filled by cutting a document
MIN_CUT = 16
MERGE_PARTITIONS = 64
_LOCAL_BITS = 33
_MERGED = 1 << 61


class Windows:
    """Open sequences of one partition, by room."""

    def __init__(self, capacity: int, limit: int, partition: int):
        self.capacity, self.limit = capacity, limit
        self.base, self.made = partition << _LOCAL_BITS, 0
        self.open: list[tuple[int, int]] = []  # (room, sequence id), by rising room

    def new_id(self) -> int:
        self.made += 1
        return self.base + self.made - 1

    def place(self, start: int, length: int) -> Iterator[tuple[int, int, int, int]]:
        """Pieces ``(start, length, sequence, offset)`` of a document's last ``length`` tokens."""
        while length:
            at = bisect_left(self.open, (length, -1))
            if at < len(self.open):  # best fit: the least room that is enough
                room, sequence = self.open.pop(at)
                yield start, length, sequence, self.capacity - room
                if room > length:
                    insort(self.open, (room - length, sequence))
                return
            if len(self.open) < self.limit:
                sequence = self.new_id()
                yield start, length, sequence, 0
                if length < self.capacity:
                    insort(self.open, (self.capacity - length, sequence))
                return
            room, sequence = self.open.pop(0)  # none fits: the fullest goes
            if room >= MIN_CUT:
                yield start, room, sequence, self.capacity - room
                start, length = start + room, length - room


def piece_schema(id_type: T.DataType, with_ids: bool) -> T.StructType:
    long = T.LongType()
    fields = [("doc_id", id_type), *((c, long) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"))]
    if with_ids:
        fields.append(("ids", T.BinaryType()))
    fields += [("part", T.IntegerType()), ("is_open", T.BooleanType())]
    return T.StructType([T.StructField(n, t) for n, t in fields])


def _pack_partition(schema: pa.Schema, tokenizer: str, capacity: int, limit: int, with_ids: bool):
    end = END_ID.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        windows, code = Windows(capacity, limit, part), encoder(tokenizer)
        held: dict[int, list[dict]] = {}  # pieces of windows that are still open
        for batch in batches:
            for s in slices(batch.column(1), ENCODE_BYTES):
                out: list[dict] = []
                ids, at = code.encode(s)
                raw, at = ids.astype("<u4", copy=False).tobytes(), (4 * at).tolist()
                for i, doc_id in enumerate(batch.column(0).slice(s.first, s.n).to_pylist()):
                    tokens = raw[at[i] : at[i + 1]] + end
                    n = len(tokens) // 4
                    whole = n - n % capacity
                    pieces = [(at, capacity, windows.new_id(), 0) for at in range(0, whole, capacity)]
                    pieces += windows.place(whole, n - whole)
                    for start, length, sequence, offset in pieces:
                        own = tokens[4 * start : 4 * (start + length)]
                        row = {"doc_id": doc_id, "start": start, "length": length, "ids_crc32": zlib.crc32(own), "doc_tokens": n,
                               "sequence_id": sequence, "offset": offset, "part": part, "is_open": False}
                        if with_ids:
                            row["ids"] = own
                        if length == capacity:
                            out.append(row)
                        else:
                            held.setdefault(sequence, []).append(row)
                still = {sequence for _, sequence in windows.open}
                for sequence in [s for s in held if s not in still]:
                    out += held.pop(sequence)
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
        rest = [row | {"is_open": True} for rows in held.values() for row in rows]
        if rest:
            yield pa.RecordBatch.from_pylist(rest, schema=schema)

    return run


def _merge(capacity: int):
    """Merge the open windows of a group of partitions, best-fit by falling size."""

    def run(key, table):  # pyarrow tables; Spark must not see annotations here
        used: dict[int, int] = {}
        for sequence, length in zip(table["sequence_id"].to_pylist(), table["length"].to_pylist()):
            used[sequence] = used.get(sequence, 0) + length
        place: dict[int, tuple[int, int]] = {}
        rooms: list[tuple[int, int]] = []
        base, made = _MERGED + (key[0].as_py() << _LOCAL_BITS), 0
        for sequence in sorted(used, key=lambda s: (-used[s], s)):
            size = used[sequence]
            at = bisect_left(rooms, (size, -1))
            if at < len(rooms):
                room, target = rooms.pop(at)
            else:
                room, target, made = capacity, base + made, made + 1
            place[sequence] = (target, capacity - room)
            if room > size:
                insort(rooms, (room - size, target))
        old = table["sequence_id"].to_pylist()
        offsets = [place[s][1] + o for s, o in zip(old, table["offset"].to_pylist())]
        table = table.set_column(table.schema.get_field_index("sequence_id"), "sequence_id", pa.array([place[s][0] for s in old], pa.int64()))
        return table.set_column(table.schema.get_field_index("offset"), "offset", pa.array(offsets, pa.int64()))

    return run


def pack(docs: DataFrame, scratch: Scratch, tokenizer: str | None = None, seq_tokens: int = SEQ_TOKENS,
         open_windows: int = OPEN_WINDOWS, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``with_ids`` adds each piece's ids (``ids``: little-endian unsigned 32-bit).
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = piece_schema(docs.schema["doc_id"].dataType, with_ids)
    run = _pack_partition(to_arrow_schema(schema), tokenizer or default_tokenizer(), seq_tokens, open_windows, with_ids)
    pieces = scratch.table(docs.select("doc_id", "text").mapInArrow(tidy(run), schema), "pieces")
    group = F.floor(F.col("part") / MERGE_PARTITIONS).cast("bigint")
    merged = pieces.filter("is_open").groupBy(group.alias("merge_group")).applyInArrow(_merge(seq_tokens), schema)
    return pieces.filter("NOT is_open").unionByName(merged).drop("part", "is_open")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(docs, Scratch(spark, "packing"))
