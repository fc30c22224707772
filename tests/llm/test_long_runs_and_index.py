"""Texts of one long run, the persistent digest index, and size filters of the n-gram join."""

import random
import re
import time

import pytest
from helpers import pii_base, secret_base
from pyspark.sql import functions as F

from soarcast.llm import exact_dedup, pii, secrets
from soarcast.llm.scratch import Scratch
from soarcast.session import session_settings

# the endpoint pattern as one alternation, which tries every place of a name again
PLAIN_ENDPOINT = re.compile(
    r"""[a-z][a-z0-9+.-]{1,20}://[^\s"'<>]+|(?:host|endpoint|server|url)["']?\x20*[:=]\x20*["']?([A-Za-z0-9.-]+\.[a-z]{2,})|[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+:[0-9]{2,5}\b""", re.A)


def long_texts(n):
    return ["a" * n, "7" * n, "a." * (n // 2), "a-" * (n // 2), "password=" + "aB3+" * (n // 4), "1.1.1." * (n // 6), "a@" * (n // 2), "a@b." * (n // 4), "host=" * (n // 5), "+1" * (n // 2)]


def test_endpoints_equal_the_plain_pattern():
    rng = random.Random(6)
    parts = ["a", "b.", ".", "-", ":", "80", "9999", "123456", "host=", "url:", "http://", "x+y://", " ", '"', "c.de", "host = foo.bar9.x:80", "\n", "Z"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        assert secrets._endpoints(text) == [m.span() for m in PLAIN_ENDPOINT.finditer(text)], text


def test_secret_scans_are_linear_in_one_long_run():
    for text in long_texts(1_000_000):
        at = time.time()
        found = secrets.scan(text)
        assert time.time() - at < 20, text[:10]
        if len(text) <= 1_000_000 and "=" not in text[:12]:
            continue
        assert [x for x in found if not x[3]][:1] == ([("assign", 0, len(text), False)] if text.startswith("password") else [])


def test_pii_is_linear_in_one_long_run(spark):
    texts = long_texts(200_000)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(len(texts))
    at = time.time()
    assert pii.find(df, Scratch(spark, "t")).count() == len(texts)
    assert time.time() - at < 120  # minutes each when every place of a run is tried


def test_pii_base_spans_of_random_texts(spark):
    rng = random.Random(9)
    parts = ["a", "b_c", ".", "@", "@x", ".de", "-", "%", "1", "255", "0", " ", "+49 ", "4111 1111 1111 1111", "1.2.3.4", "é", "\n", "(at)", "d@e.f_g@h.i"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for r in pii.find(df, Scratch(spark, "t")).collect():
        base = [(x.start, pii.KINDS.index(x.kind), x.end, x.kind) for x in r.spans if x.base]
        assert sorted(base) == sorted(pii_base(texts[r.doc_id])), texts[r.doc_id]


def test_secret_base_spans_of_random_texts():
    rng = random.Random(10)
    parts = ["password", "api_key", "token", "=", ":", " ", "abcdef0123456789", "AKIA", "ABCDEFGHIJKLMNOP", "x.y:80", "-", '"', "\n", "é"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 20)))
        base = [(s, secrets.KINDS.index(k), e, k) for k, s, e, weak in secrets.scan(text) if not weak]
        assert sorted(base) == sorted(secret_base(text)), text


def texts_frame(spark, lo, hi):
    return spark.range(lo, hi).select(F.col("id").alias("doc_id"), F.concat(F.lit("text number "), "id").alias("text"))


@pytest.mark.parametrize("partitions", ["4", "16"])
def test_a_reopened_index_knows_every_text(spark, partitions):
    scratch = Scratch(spark, "t")
    path = scratch.path("index")
    with session_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        with session_settings(spark, {"spark.sql.shuffle.partitions": "8"}):
            index = exact_dedup.DigestIndex(spark, path, "llm_reopened")
            assert exact_dedup.deduplicate(texts_frame(spark, 0, 200), index, Scratch(spark, "t")).filter("kept").count() == 200
            index.close()
        with session_settings(spark, {"spark.sql.shuffle.partitions": partitions}):
            again = exact_dedup.DigestIndex(spark, path, "llm_reopened")
            assert again.buckets == 8
            rows = exact_dedup.deduplicate(texts_frame(spark, 100, 300), again, Scratch(spark, "t")).collect()
            assert sorted(r.doc_id for r in rows if r.kept) == list(range(200, 300))
            assert all(r.keep_id == r.doc_id for r in rows)
            again.compact(buckets=int(partitions))
            assert again.table().count() == 300 and again.buckets == int(partitions)
            again.close()
        last = exact_dedup.DigestIndex(spark, path, "llm_reopened")
        assert last.buckets == int(partitions)
        assert exact_dedup.deduplicate(texts_frame(spark, 0, 300), last, Scratch(spark, "t")).filter("kept").count() == 0
        last.close()
    with pytest.raises(ValueError, match="ids of type bigint"):
        exact_dedup.DigestIndex(spark, path, "llm_reopened", id_type="string")
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("llm_reopened")]


def test_rows_repeated_with_a_null_id_spread_and_keep_one(spark):
    same = spark.range(3000).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("the same").alias("text"))
    rows = exact_dedup.deduplicate_alone(same.unionByName(texts_frame(spark, 0, 10)), Scratch(spark, "t"))
    kept = rows.filter("kept").collect()
    assert sorted(r.group_size for r in kept) == [1] * 10 + [3000] and rows.count() == 3010
