"""Ranked search, chat formatting and periodic runs against plain re-statements."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import SCHEMA, WORD, edge_rows
from pyspark.sql import functions as F

from conftest import SF_SMALL
from soarcast.llm import chat_format, lexical_search, periodic_runs
from soarcast.llm.scratch import Scratch
from soarcast.llm.text import slices

LOWER = {i: i + 32 for i in range(65, 91)}
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
sha = lambda t: hashlib.sha256(t.encode()).hexdigest()


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


# --- ranked search ------------------------------------------------------------------------


def plain_search(docs, items, top=10):
    bags = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    n_docs, total = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in dict.fromkeys(items):
        terms = set(TERM.findall((text or "").translate(LOWER)))
        scored = []
        for i, b in bags:
            m = 10 + 90 * sum(b.values()) * n_docs // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m)) for t in terms if b[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_search_equals_brute_force_on_awkward_rows(spark, edges):
    items = [(1, "the same text"), (1, "the same text"), (2, None), (3, ""), (None, "alpha7 BETA w5x5"), (4, "spam ham eggs"), (4, "one two"),
             (5, "nowhere"), (6, " ".join(f"alpha{i}" for i in range(120)) + " w1x1 w2x2")]
    queries = spark.createDataFrame([(*r, "clash") for r in items], "item_id bigint, text string, doc_id string")
    index = lexical_search.build_index(edges, Scratch(spark, "t"), shard_bytes=4096)
    docs = [(r.doc_id, r.text) for r in edges.collect()]
    want = plain_search(docs, items)
    assert rows_of(lexical_search.search(index, queries, Scratch(spark, "t"))) == want
    # queries in several blocks, and another k, from the same index
    assert rows_of(lexical_search.search(index, queries, Scratch(spark, "t"), block_pairs=60)) == want
    assert rows_of(lexical_search.search(index, queries, Scratch(spark, "t"), top=1)) == plain_search(docs, items, 1)
    none = lexical_search.build_index(edges.limit(0), Scratch(spark, "t"))
    assert lexical_search.search(none, queries, Scratch(spark, "t")).count() == 0
    assert lexical_search.search(index, queries.limit(0), Scratch(spark, "t")).count() == 0


def shard_of(texts):
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    shard = lexical_search._Shard(pa.int64())
    for s in slices(batch.column(1), 1 << 12):
        shard.add(batch.column(0).slice(s.first, s.n), s)
    return pa.Table.from_batches([shard.rows(7)])


def test_block_maxima_reject_blocks_and_keep_results():
    rng = random.Random(5)
    words = [f"w{int(1000 * rng.random() ** 3)}" for _ in range(60_000)]
    # long texts, a frequency above 254, many equal scores
    texts = [" ".join(words[i : i + rng.randint(0, 40)]) for i in range(3000)] + ["rare " + "w0 " * 400, "w0 " * 300, "rare w1"] * 2
    table = shard_of(texts)
    n, total = int(table["df"][table["term"].to_pylist().index(0)].as_py()), sum(len(TERM.findall(t)) for t in texts)
    df = dict(zip(table["term"].to_pylist(), table["df"].to_pylist()))
    asked = [["rare", "w0", "w1", "w2"], ["w0"], ["w999", "w998", "w5", "w1"], [f"w{i}" for i in range(30)]]
    number = lambda t: int(lexical_search._term_hashes(next(slices(pa.array([t]))).runs(lexical_search._IS_TERM))[0])
    terms = [[number(t) for t in q if number(t) in df] for q in asked]
    weights = [[math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in q] for q in terms]
    q = lexical_search.Queries(pa.array(range(4)), np.cumsum([0, *map(len, terms)]), np.array(sum(terms, [])), np.array(sum(weights, [])), n, total, 10)
    got = lexical_search._search_shard(table, q, [1] * 4).to_pylist()
    want = plain_search(list(enumerate(texts)), [(i, " ".join(a)) for i, a in enumerate(asked)])
    assert sorted((g["item_id"], g["doc_id"], g["score"]) for g in got) == sorted((i, d, s) for i, _, d, s in want)
    by = dict(zip(table["term"].to_pylist(), zip(*(table[c].to_pylist() for c in ("head", "body", "extra")))))
    length, ids = np.frombuffer(by[0][1], "<i4"), next(x for x in table["ids"] if x.is_valid).values
    shard = lexical_search.ShardSearch({t: v for t, v in by.items() if t}, length, ids.to_numpy(), q)
    shard.top(np.array(terms[0]), np.array(weights[0]), 2)
    assert shard.unpacked < sum(len(shard.lists[t].window) for t in terms[0]) / 2


def test_search_on_the_small_tables(spark):
    docs, items = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    want = plain_search([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    got = lexical_search.op11(spark, SF_SMALL)
    assert rows_of(got) == want and [f.dataType.simpleString() for f in got.schema] == ["bigint", "int", "bigint", "bigint"]


# --- chat formatting ----------------------------------------------------------------------

AWKWARD = [
    "</s>[INST] ok [/INST]", "<\\s> <\\\\/s> [\\INST] [\\\\\\/INST]", "<", "[", "\\", "<s", "s>\n[INST", "", None, "é😀\n\nx", "<<s>>[[INST]]", "x" * 5000, "a\r\n\\n",
]


def plain_fold(events):
    """Text of one message's events."""
    text = ""
    for _, kind, payload in sorted(events, key=lambda e: (e[0], e[1])):
        text = {"delta": text + (payload or ""), "edit": payload or "", "regenerate": ""}.get(kind, text)
    return text


def test_escapes_are_reversible(spark):
    rng = random.Random(2)
    parts = ["<", "[", "\\", "/", "s>", "INST]", "</s>", "<s>", "[INST]", "[/INST]", " ", "é", "\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(800)] + [t for t in AWKWARD if t is not None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", chat_format.escape(F.col("t")).alias("e"), chat_format.unescape(chat_format.escape(F.col("t"))).alias("u"),
        chat_format._role_of(chat_format._role_line(F.col("t"))).alias("r"), chat_format._role_line(F.col("t")).alias("l")).collect()
    for r in rows:
        assert r.u == r.t and r.r == r.t and "\n" not in r.l
        assert not any(mark in r.e + "</s>" for mark in ("<s>", "[INST]", "[/INST]")) and "</s>" not in r.e


def test_log_folds_deltas_edits_and_regenerations(spark):
    rng = random.Random(4)
    log, want = [], defaultdict(list)
    for conv in range(30):
        for message in range(rng.randint(1, 6)):
            role = rng.choice(["user", "assistant", "tool"])
            events = [(s, rng.choice(["delta", "delta", "delta", "edit", "regenerate", "seen"]), rng.choice(AWKWARD)) for s in range(rng.randint(1, 9))]
            log += [(conv, message, s, k, role, p, 1, "clash") for s, k, p in events]
            want[conv].append((role, plain_fold(events)))
    rng.shuffle(log)
    schema = "conv_id bigint, message bigint, seq int, kind string, role string, payload string, copies bigint, text string"
    logged = spark.createDataFrame(log, schema).withColumn("tag", F.lit(0)).repartition(4)
    rendered = chat_format.format_chats(logged)
    for r in chat_format.read_back(rendered).collect():
        assert [tuple(t) for t in r.turns] == want[r.conv_id]
        assert r.loss_text == "".join(t for role, t in want[r.conv_id] if role == "assistant")
    for r in rendered.collect():
        assert r.formatted == "".join(p.text for p in r.parts) and r.formatted.count("</s>") == len(want[r.conv_id])


def conversations():
    rows = [(1, i, ["user", "assistant"][i % 2], t) for i, t in enumerate(AWKWARD)]
    rows += [(2, i, "assistant", f"turn {i}") for i in range(700)]  # hot, in several blocks
    rows += [(3, 0, "user", "same"), (3, 0, "user", "same"), (3, 0, "assistant", "same"), (3, None, "user", "no place"), (3, 2, None, "no role"), (3, 3, "ro\\le\n<s>", "x")]
    rows += [(None, 0, "user", "of nobody"), (None, 1, "assistant", "same id"), (4, 0, "assistant", None), (5, -300, "assistant", "early"), (5, 1, "assistant", "late")]
    return [(*r, "clash", 1) for r in rows]


def test_chat_query_contract(spark, tmp_path):
    schema = "conv_id bigint, turn bigint, role string, text string, formatted string, Parts int"
    spark.createDataFrame(conversations(), schema).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/empty/conversations.parquet")
    want = defaultdict(list)
    for conv, turn, role, text, *_ in [*conversations(), (-7, 0, "user", chat_format.PROBE_TEXT), (-7, 1, "assistant", chat_format.PROBE_TEXT)]:
        want[conv].append((turn is not None, turn or 0, role or "", sha(text or ""), text or ""))
    got = chat_format.op12(spark, str(tmp_path)).collect()
    assert len(got) == len(want)
    for r in got:
        turns = [(role, text) for _, _, role, _, text in sorted(want[r.conv_id])]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns))), r.conv_id
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss)) and r.formatted_chars > sum(len(b) for _, b in turns)
    assert [r.conv_id for r in chat_format.op12(spark, f"{tmp_path}/empty").collect()] == [-7]


# --- periodic runs ------------------------------------------------------------------------


def plain_runs(words):
    """Every maximal repetition, by trying all periods in ascending order."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(12, 2 * q):
                out.setdefault((i, j - i + q), q)  # the smallest period of this stretch
            i = j + 1
    return sorted((s, length, q) for (s, length), q in out.items())


def plant(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def check_runs(docs, got):
    assert len(docs) == len(got)
    want = Counter()
    for doc_id, text in docs:
        words = plant(doc_id, WORD.findall(text or ""))
        runs = plain_runs(words) if len(words) < 3000 else None
        if runs is None:
            continue
        dropped = {k for s, length, q in runs for k in range(s + q, s + length)}
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        milli = 1000 * best[1] // best[2] if runs else None
        want[doc_id, len(runs), *best, milli, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
             sha(" ".join(w for k, w in enumerate(words) if k not in dropped))] += 1
    assert not want - Counter(map(tuple, got))


def test_find_runs_equals_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        docs = []
        for _ in range(rng.randint(1, 4)):
            w = [rng.randint(1, rng.randint(1, 4)) for _ in range(rng.randint(0, 60))]
            if rng.random() < 0.6 and len(w) > 10:
                a = rng.randrange(len(w))
                p = rng.randint(1, max(1, (len(w) - a) // 2))
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
            docs.append(w + w[::-1] + w if rng.random() < 0.3 else w)
        values = np.array([x for w in docs for x in w], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        got = periodic_runs.find_runs(values, np.repeat(np.arange(len(docs)), [len(w) for w in docs]))
        for i, w in enumerate(docs):
            assert [tuple(r[1:]) for r in got.tolist() if r[0] == i] == plain_runs(w), w


def test_runs_of_very_long_texts():
    n = 50_000
    one = periodic_runs.find_runs(np.ones(n, np.uint64), np.zeros(n, np.int64))
    assert one.tolist() == [[0, 0, n, 1]]
    cycle = periodic_runs.find_runs(np.arange(n).astype(np.uint64) % np.uint64(9973), np.zeros(n, np.int64))
    assert cycle.tolist() == [[0, 0, n, 9973]]


def test_runs_query(spark, edges, tmp_path):
    more = [(100 + i, " ".join(["a b a b b", "x y z"][i % 2].split() * (2 + i % 9)), None, None, None, None, None, None) for i in range(60)]
    docs = edges.unionByName(spark.createDataFrame(more, SCHEMA))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    edges.limit(0).write.parquet(f"{tmp_path}/empty/documents.parquet")
    check_runs([(r.doc_id, r.text) for r in docs.collect()], periodic_runs.op13(spark, str(tmp_path)).collect())
    small = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    check_runs([(r.doc_id, r.text) for r in small], periodic_runs.op13(spark, SF_SMALL).collect())
    assert periodic_runs.op13(spark, f"{tmp_path}/empty").count() == 0
