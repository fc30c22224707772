"""Training-order materialisation: fixed-stride shards of token sequences in a keyed order.

Documents become sequences of ``SEQ_TOKENS`` ids, a partition's documents one after another,
each ended by the end token; only a partition's last sequence is padded. A first pass counts
the sequences of every partition, so each sequence has an index below their total ``N``. A
keyed Feistel network on the next even number of bits, walked along its cycle until the value
is below ``N``, permutes the indexes: every sequence knows its slot without any shared state.
One shuffle by slot range puts the records of a shard into one task (of at most ``MAX_TASKS``, each
with a range of neighbouring shards), which sorts them, spilling as it must, and writes them in order. A record has the same number of bytes everywhere, so slot ``s`` is in shard
``s div rows_per_shard`` at byte ``(s mod rows_per_shard) * stride``, and a reader that
stopped can go on from any slot.

Record, little-endian: index (8 bytes), id of the document of its first token (8; -1 if it is
null or no integer), that token's place in the document (8), number of tokens (4), ids (2 or 4
bytes each, by the size of the vocabulary), a newline (1), which is how Spark's text writer
ends a line. Files go through that writer and its commit protocol, so a lost task leaves
nothing behind and any store that Spark writes to will do.

The second pass numbers its sequences by what the first counted and fails if a partition
gives another number, rather than leave holes. Defined results: a null or empty text is the
end token alone; repeated rows are repeated; an empty table writes no shard and gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch
from .text import mix, slices
from .tokens import ENCODE_BYTES, END_ID, default_tokenizer, encoder

SEQ_TOKENS, PAD_ID = 1024, 0
ROWS_PER_SHARD = 8192
#: most tasks that write shards; with more shards (of 17 to 34 MB) than this a task writes several
MAX_TASKS = 1 << 16
ROUNDS, KEY = 6, 20240229


def record_type(seq_tokens: int, vocabulary: int) -> np.dtype:
    ids = "<u2" if vocabulary <= 1 << 16 else "<u4"
    return np.dtype([("index", "<u8"), ("doc_id", "<i8"), ("start", "<u8"), ("n", "<u4"), ("ids", ids, (seq_tokens,))])


def permute(index: np.ndarray, total: int, key: int = KEY) -> np.ndarray:
    """Slots of ``index``: a bijection of ``range(total)``, by Feistel rounds and cycle-walking."""
    half = max(1, (max(total - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for r in range(ROUNDS):
            left, right = right, left ^ (mix(right + np.uint64((key * 31 + r) % (1 << 40) << 20)) & mask)
        out[todo] = left << np.uint64(half) | right
        todo = todo[out[todo] >= total]
    return out.astype(np.int64)


class Sequences:
    """Cuts a partition's token stream into records, remembering where each one's first token lies."""

    def __init__(self, dtype: np.dtype, seq_tokens: int):
        self.dtype, self.size = dtype, seq_tokens
        self.rest = np.zeros(0, np.uint32)  # tokens of the open sequence, and of whom the first is
        self.open = (-1, 0)

    def add(self, ids: np.ndarray, at: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Records that are complete after texts ``docs`` with ids ``ids[at[i]:at[i + 1]]`` are added."""
        n = len(docs)
        ends = at[1:] + np.arange(1, n + 1)  # with an end token after each text
        stream = np.full(len(ids) + n, END_ID, np.uint32)
        keep = np.ones(len(stream), bool)
        keep[ends - 1] = False
        stream[keep] = ids
        carried = len(self.rest)
        tokens = np.concatenate([self.rest, stream])
        whole = len(tokens) // self.size
        first = np.arange(whole + 1) * self.size - carried  # in the stream; below zero: carried
        owner = np.minimum(np.searchsorted(ends, first, side="right"), n - 1)
        begin = np.concatenate([[0], ends[:-1]])[owner]
        records = np.zeros(whole, self.dtype)
        records["ids"] = tokens[: whole * self.size].reshape(whole, self.size)
        records["n"] = self.size
        records["doc_id"], records["start"] = docs[owner[:-1]], np.maximum(first[:-1] - begin[:-1], 0)
        if whole and carried:
            records["doc_id"][0], records["start"][0] = self.open
        if whole or not carried:
            self.open = (int(docs[owner[-1]]), int(max(first[-1] - begin[-1], 0)))
        self.rest = tokens[whole * self.size :]
        return records

    def last(self) -> np.ndarray:
        """The padded last record, if tokens are left."""
        records = np.zeros(int(len(self.rest) > 0), self.dtype)
        if len(records):
            records["ids"][0] = PAD_ID
            records["ids"][0, : len(self.rest)] = self.rest
            records["n"], records["doc_id"], records["start"] = len(self.rest), *self.open
        return records


def _integers(ids: pa.Array) -> np.ndarray:
    if not pa.types.is_integer(ids.type):
        return np.full(len(ids), -1, np.int64)
    return ids.cast(pa.int64()).fill_null(-1).to_numpy()


def _count(tokenizer: str, seq_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        code, total = encoder(tokenizer), 0
        for batch in batches:
            for s in slices(batch.column(1), ENCODE_BYTES):
                total += code.count(s) + s.n
        if total:
            yield pa.record_batch([pa.array([TaskContext.get().partitionId()]), pa.array([-(-total // seq_tokens)])], names=["part", "n"])

    return run


def _records(tokenizer: str, dtype: np.dtype, seq_tokens: int, bases: dict[int, tuple[int, int]], total: int, key: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        base, expected = bases.get(part, (0, 0))
        code, cutter, made = encoder(tokenizer), Sequences(dtype, seq_tokens), 0

        def numbered(records: np.ndarray) -> pa.RecordBatch:
            nonlocal made
            records["index"] = np.arange(base + made, base + made + len(records))
            made += len(records)
            slot = permute(records["index"], total, key)
            width = dtype.itemsize
            offsets = pa.py_buffer((np.arange(len(records) + 1) * width).astype(np.int32))
            data = pa.Array.from_buffers(pa.binary(), len(records), [None, offsets, pa.py_buffer(records.tobytes())])
            return pa.record_batch([pa.array(slot), data], names=["slot", "record"])

        for batch in batches:
            for s in slices(batch.column(1), ENCODE_BYTES):
                ids, at = code.encode(s)
                records = cutter.add(ids, at, _integers(batch.column(0).slice(s.first, s.n)))
                if len(records):
                    yield numbered(records)
        records = cutter.last()
        if len(records):
            yield numbered(records)
        if made != expected:
            raise RuntimeError(f"partition {part} gave {made} sequences, but {expected} when they were counted: the input changed in between")

    return run


def write_shards(docs: DataFrame, path: str, tokenizer: str | None = None, seq_tokens: int = SEQ_TOKENS,
                 rows_per_shard: int = ROWS_PER_SHARD, key: int = KEY) -> dict:
    """Write all shards under ``path``; returns what a reader needs: counts, stride, record type."""
    tokenizer = tokenizer or default_tokenizer()
    docs = docs.select("doc_id", "text")
    counted = docs.mapInArrow(_count(tokenizer, seq_tokens), "part bigint, n bigint").toArrow()  # one row per partition
    bases, total = {}, 0
    for part, n in sorted(zip(counted["part"].to_pylist(), counted["n"].to_pylist())):
        bases[part] = (total, n)
        total += n
    from tokenizers import Tokenizer

    dtype = record_type(seq_tokens, Tokenizer.from_file(tokenizer).get_vocab_size())
    layout = {"path": path, "total": total, "seq_tokens": seq_tokens, "rows_per_shard": rows_per_shard, "stride": dtype.itemsize + 1, "dtype": dtype}
    if total:
        records = docs.mapInArrow(_records(tokenizer, dtype, seq_tokens, bases, total, key), "slot bigint, record binary")
        shards = -(-total // rows_per_shard)
        tasks = min(shards, MAX_TASKS)
        placed = records.withColumn("shard", F.expr(f"cast(slot div {rows_per_shard} as int)"))
        # neighbouring shards go to one task, which writes one after another
        ranged = placed.withColumn("task", F.expr(f"cast(cast(shard as bigint) * {tasks} div {shards} as int)"))
        ranges = ranged.repartitionById(tasks, "task").sortWithinPartitions("shard", "slot")
        ranges.select("shard", F.col("record").cast("string").alias("value")).write.mode("overwrite").partitionBy("shard").text(path)
    return layout


def read_shards(spark: SparkSession, layout: dict, first_slot: int = 0) -> DataFrame:
    """Records from ``first_slot`` on, each shard's in order: ``slot, shard, byte_offset,
    sequence, doc_id, start, n_tokens, ids`` (little-endian, as stored)."""
    dtype, stride, per_shard = layout["dtype"], layout["stride"], layout["rows_per_shard"]
    schema = "slot bigint, shard int, byte_offset bigint, sequence bigint, doc_id bigint, start bigint, n_tokens int, ids binary"
    if not layout["total"]:
        return spark.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                lines = np.frombuffer(content.as_buffer(), np.uint8).reshape(-1, stride)
                skip = max(first_slot - shard * per_shard, 0)
                for lo in range(skip, len(lines), 1024):
                    records = np.ascontiguousarray(lines[lo : lo + 1024, :-1]).view(dtype)[:, 0]
                    row = np.arange(lo, lo + len(records))
                    number = lambda x, t=pa.int64(): pa.array(np.asarray(x).astype(np.int64), t)
                    yield pa.record_batch(
                        [number(shard * per_shard + row), number(np.full(len(row), shard), pa.int32()), number(row * stride), number(records["index"]),
                         number(records["doc_id"]), number(records["start"]), number(records["n"], pa.int32()), pa.array([x.tobytes() for x in records["ids"]], pa.binary())],
                        names=["slot", "shard", "byte_offset", "sequence", "doc_id", "start", "n_tokens", "ids"])

    files = spark.read.format("binaryFile").load(layout["path"]).filter(F.col("shard") >= first_slot // per_shard)
    return files.select(F.col("shard").cast("int"), "content").mapInArrow(run, schema)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "training-order")
    layout = write_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch.path("shards"))
    rows = read_shards(spark, layout)
    return rows.select("slot", "shard", "byte_offset", "sequence", "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
