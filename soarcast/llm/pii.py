"""Personal data by weak supervision (native: DataFrame operations only).

1. Regular expressions find base spans (a strict pattern and a validity test for each kind) and
   further candidates: what matched but failed the test, obfuscated addresses, national phone
   formats, long-form IP addresses. Base spans always stay.
2. Five labelers vote on every candidate for, against, or not at all: its shape, its
   validity, a gazetteer, words before it, and what touches it.
3. Expectation maximisation estimates, for every kind, how often each labeler votes what on
   true and on false candidates. It needs only the counts of vote patterns (at most 3^5 for a
   kind), so it is one SQL expression over a table of bounded size.
4. The resulting posteriors are soft labels of a naive Bayes classifier of spans, whose features
   are the votes, the shape and the bytes around a span, hashed to ``CELLS`` cells. Candidates
   that it gives ``ACCEPT`` or more are added, unless they overlap a base span.

Texts are read once; what is found in them is written to the shared folder, and everything
else works on that. Positions are code points, end exclusive: with the pieces between matches
and the matches themselves, a position is the sum of what comes before it.

Defined results: null and empty texts have no spans; repeated rows are scanned each for
itself; without any candidate of a kind nothing is added; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch
from .secrets import joined

#: kinds in the order of the contract
KINDS = ("email", "ip", "card", "phone")
# What begins with a run of a class is tried where the run begins or a match just ended: from any
# other place in the run the rest is the same and fails alike, and a long run would cost its square.
_LOCAL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++"
# fixed patterns of the contract; possessive repeats where nothing that follows could give back
BASE = {
    "email": _LOCAL + r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # a run with fewer than 14 digits fails the test whatever it is: it need not match
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: candidates beside the base patterns
MORE = {
    "email": _LOCAL + r"\x20?[(\[{](?i:at)[)\]}]\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[(\[{](?i:dot)[)\]}])\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}",
    "phone": r"\([0-9]{3}\)\x20?[0-9]{3}[\x20.-][0-9]{4}|[0-9]{3}[\x20.-][0-9]{3}[\x20.-][0-9]{4}",
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_DOMAINS = r"(?i)[.\x20)\]}](com|org|net|edu|gov|info|io|de|fr|es|uk|eu)$"
_NETWORKS = r"^(4|5[1-5]|2[2-7]|3[47]|6011|65)"
_CALLING = r"^\+(1|7|2[07]|3[0-469]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
_WORDS = {
    "email": r"(?i)(e-?mail|contact|write to|reach)[^A-Za-z]*$",
    "ip": r"(?i)\b(ip|host|server|addr(ess)?|from)[^A-Za-z]*$",
    "card": r"(?i)\b(card|visa|mastercard|amex|credit|pay(ment)?)[^A-Za-z]*$",
    "phone": r"(?i)\b(tel|phone|call|fax|mobile|cell)[^A-Za-z]*$",
}
_AGAINST = r"(?i)(isbn|version|order|serial|part no|id)[^A-Za-z]*$"
LABELERS = 5
#: code points on either side that labelers and classifier look at
AROUND = 24
#: matches of a chunk of the running sum of positions
CHUNK = 256
ROUNDS, SMOOTH = 25, 1.0
CELLS, ACCEPT = 64, 0.9
#: feature slots of a span: the votes, its shape, its length, and the bytes on either side
SLOTS = LABELERS + 4

_SPAN = "struct<kind:string,start:bigint,end:bigint,value:string,left:string,right:string,base:boolean>"


def _with_spans(df: DataFrame, name: str, kind: str, pattern: str) -> DataFrame:
    """Add ``name``: all matches of ``pattern`` in ``text`` with positions and surroundings.

    A match ends where the pieces and matches up to it end. The running sum goes by chunks of
    ``CHUNK`` matches, so its cost grows with the matches, not their square; what a lambda
    looks into is always a column of its own, since its body is evaluated for every element.
    """
    text = F.col("text")
    df = df.withColumn("_found", F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(0)))
    between = F.split(text, pattern, -1)
    zipped = F.arrays_zip(F.col("_found").alias("value"), between.alias("gap"), F.slice(between, 2, 1 << 30).alias("next"))
    piece = F.transform(F.filter(zipped, lambda x: x["value"].isNotNull()), lambda x: F.struct(
        x["value"].alias("value"), F.right(x["gap"], F.lit(AROUND)).alias("left"), F.left(F.coalesce(x["next"], F.lit("")), F.lit(AROUND)).alias("right"),
        (F.length(x["gap"]) + F.length(x["value"])).alias("n")))
    none = F.array().cast("array<struct<value:string,left:string,right:string,n:int>>")
    df = df.withColumn("_pieces", F.when(F.size("_found") > 0, piece).otherwise(none))
    zero = F.lit(0).cast("bigint")
    total = lambda begin, n: F.aggregate(F.slice("_pieces", begin, n), zero, lambda acc, x: acc + x["n"])
    last = F.floor((F.size("_pieces") - 1) / CHUNK).cast("int")
    sums = F.when(F.size("_pieces") > 0, F.transform(F.sequence(F.lit(0), last), lambda k: total(k * CHUNK + 1, F.lit(CHUNK))))
    running = F.aggregate(sums, F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("starts")), lambda acc, n: F.struct(
        (acc["at"] + n).alias("at"), F.array_append(acc["starts"], acc["at"]).alias("starts")))["starts"]
    df = df.withColumn("_starts", running)
    chunk = lambda i: F.floor(i / CHUNK).cast("int")
    end = lambda i: F.get("_starts", chunk(i)) + total(chunk(i) * CHUNK + 1, (i - chunk(i) * CHUNK + 1).cast("int"))
    spans = F.transform("_pieces", lambda x, i: F.struct(
        F.lit(kind).alias("kind"), (end(i) - F.length(x["value"])).cast("bigint").alias("start"), end(i).alias("end"),
        x["value"].alias("value"), x["left"].alias("left"), x["right"].alias("right"), F.lit(False).alias("base")))
    return df.withColumn(name, F.when(F.size("_starts") > 0, spans).otherwise(F.array()).cast(f"array<{_SPAN}>")).drop("_found", "_pieces", "_starts")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    """The base rule's test of a match."""
    n = F.length(_digits(value))
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return n.between(14, 19) & F.call_function("luhn_check", _digits(value))
    if kind == "phone":
        return n.between(10, 15)
    return F.lit(True)


def _votes(x: Column, kind: str) -> list[Column]:
    """Votes on a candidate: 1 for, 0 against, 2 none."""
    value, digits = x["value"], _digits(x["value"])
    n = F.length(digits)
    yes_no = lambda c: F.when(c, 1).otherwise(0)
    yes = lambda c: F.when(c, 1).otherwise(2)
    no = lambda c: F.when(c, 0).otherwise(2)
    if kind == "email":
        shape, valid, listed = yes_no(value.rlike(r"^[^\x20]*[@\x20(\[{]") & (F.length(value) <= 80)), yes_no(~value.rlike(r"\.\.|^\.|-\.")), yes(value.rlike(_DOMAINS))
    elif kind == "ip":
        shape, valid, listed = yes_no(value.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$|:")), yes_no(_valid("ip", value) | value.contains(":")), no(value.rlike(r"^0+\."))
    elif kind == "card":
        shape, valid, listed = yes_no(value.rlike(r"^(?:[0-9]{4}[\x20-]?){3}[0-9]{4}$|^3[47][0-9]{2}[\x20-]?[0-9]{6}[\x20-]?[0-9]{5}$")), yes_no(F.call_function("luhn_check", digits)), yes_no(digits.rlike(_NETWORKS))
    else:
        shape, valid, listed = yes_no(value.rlike(r"[\x20().-]")), yes_no(n.between(10, 15)), F.when(value.rlike(_CALLING), 1).when(value.startswith("+"), 0).otherwise(2)
    words = F.when(x["left"].rlike(_WORDS[kind]), 1).when(x["left"].rlike(_AGAINST), 0).otherwise(2)
    touched = no(x["left"].rlike(r"[A-Za-z0-9_=/#.-]$") | x["right"].rlike(r"^[A-Za-z0-9_=/#]"))
    return [shape, valid, listed, words, touched]


def _features(x: Column, votes: Column) -> Column:
    """Cells of a span, one for each slot: ``slot * CELLS + value``."""
    shape = F.regexp_replace(F.regexp_replace(x["value"], "[A-Za-z]+", "a"), "[0-9]+", "9")
    cell = lambda c: F.pmod(F.xxhash64(c), F.lit(CELLS)).cast("int")
    slots = [*[F.get(votes, F.lit(i)) for i in range(LABELERS)], cell(shape), F.least(F.length(x["value"]), F.lit(CELLS - 1)),
             cell(F.right(x["left"], F.lit(2))), cell(F.left(x["right"], F.lit(2)))]
    return F.array(*[(F.lit(i * CELLS) + c).cast("int") for i, c in enumerate(slots)])


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans``: base spans and candidates of every text, with votes and cells.

    Of the candidates that no base rule keeps, those that overlap a base span are left out.
    """
    read = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = read
    tested = lambda kind: lambda x: x.withField("base", _valid(kind, x["value"]))
    for kind in KINDS:
        found = _with_spans(found, f"_{kind}", kind, BASE[kind])
        found = found.withColumn(f"_{kind}", F.transform(f"_{kind}", tested(kind)))
    for kind in MORE:
        found = _with_spans(found, f"_more_{kind}", kind, MORE[kind])
    found = found.drop("text")
    base = F.flatten(F.array(*[F.filter(f"_{k}", lambda x: x["base"]) for k in KINDS]))
    # of failed matches only the long digit strings are worth a vote
    failed = F.filter("_card", lambda x: ~x["base"] & F.length(_digits(x["value"])).between(14, 19))
    found = found.select("doc_id", base.alias("_base"), F.flatten(F.array(failed, *[F.col(f"_more_{k}") for k in MORE])).alias("_rest"))
    clear = F.filter("_rest", lambda x: ~F.exists("_base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    found = found.select("doc_id", F.concat("_base", F.when(F.size("_rest") > 0, clear).otherwise(F.col("_rest"))).alias("_all"))

    def judged(x: Column) -> Column:
        votes = F.array(*[F.coalesce(*[F.when(x["kind"] == k, _votes(x, k)[i]) for k in KINDS]) for i in range(LABELERS)])
        return F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"), x["base"].alias("base"),
                        votes.alias("votes"), _features(x, votes).alias("cells"))

    return found.select("doc_id", F.transform("_all", judged).alias("spans"))


def reliabilities(spans: DataFrame) -> DataFrame:
    """EM over the vote patterns of each kind: ``kind, prior, hit, miss``.

    ``hit[3 j + v]`` and ``miss[3 j + v]`` are the probabilities that labeler ``j`` votes ``v``
    on a true and on a false candidate. All state of a kind is one struct.
    """
    patterns = spans.groupBy("kind", "votes").agg(F.count(F.lit(1)).cast("double").alias("n"))
    by_kind = patterns.groupBy("kind").agg(F.collect_list(F.struct("votes", "n")).alias("pats"))
    first = lambda against, support: f"array({', '.join([f'{against}D', f'{support}D', '0.3D'] * LABELERS)})"
    product = lambda table: f"aggregate(sequence(0, {LABELERS - 1}), 1D, (acc, j) -> acc * s.{table}[3 * j + p.votes[j]])"
    share = f"s.prior * {product('hit')} / (s.prior * {product('hit')} + (1D - s.prior) * {product('miss')})"
    weighed = f"transform(pats, p -> named_struct('votes', p.votes, 'n', p.n, 'q', {share}))"
    total = lambda c: f"aggregate(w, 0D, (acc, x) -> acc + {c})"
    voted = lambda c: f"aggregate(w, 0D, (acc, x) -> acc + if(x.votes[k div 3] = k % 3, {c}, 0D))"
    table = lambda c: f"transform(sequence(0, {3 * LABELERS - 1}), k -> ({voted(c)} + {SMOOTH}D) / ({total(c)} + {3 * SMOOTH}D))"
    true, false = "x.n * x.q", "x.n * (1D - x.q)"
    step = (f"transform(array({weighed}), w -> named_struct('prior', ({total(true)} + 1D) / ({total('x.n')} + 2D), "
            f"'hit', {table(true)}, 'miss', {table(false)}))[0]")
    start = f"named_struct('prior', 0.5D, 'hit', {first(0.1, 0.6)}, 'miss', {first(0.6, 0.1)})"
    state = F.expr(f"aggregate(sequence(1, {ROUNDS}), {start}, (s, i) -> {step})")
    return by_kind.select("kind", state.alias("s")).select("kind", "s.*")


def span_classifier(spans: DataFrame, model: DataFrame) -> DataFrame:
    """Naive Bayes from the EM posteriors: ``kind, bias, weights`` (a map from cell to log odds)."""
    product = lambda table: F.aggregate(
        F.sequence(F.lit(0), F.lit(LABELERS - 1)), F.lit(1.0), lambda acc, j: acc * F.get(F.col(table), (3 * j + F.get(F.col("votes"), j)).cast("int")))
    counted = spans.groupBy("kind", "votes", "cells").agg(F.count(F.lit(1)).cast("double").alias("n"))
    soft = counted.join(F.broadcast(model), "kind")  # one row for each of four kinds
    true = F.col("prior") * product("hit")
    soft = soft.withColumn("q", true / (true + (1 - F.col("prior")) * product("miss")))
    per_cell = soft.select("kind", "n", "q", F.explode("cells").alias("cell")).groupBy("kind", "cell").agg(
        F.sum(F.col("n") * F.col("q")).alias("t"), F.sum(F.col("n") * (1 - F.col("q"))).alias("f"))
    whole = soft.groupBy("kind").agg(F.sum(F.col("n") * F.col("q")).alias("all_t"), F.sum(F.col("n") * (1 - F.col("q"))).alias("all_f"))
    odds = lambda a, b: F.log((a + SMOOTH) / (b + SMOOTH))
    weight = odds(F.col("t"), F.col("f")) - odds(F.col("all_t"), F.col("all_f"))
    table = per_cell.join(F.broadcast(whole), "kind").groupBy("kind").agg(
        odds(F.first("all_t"), F.first("all_f")).alias("bias"), F.map_from_entries(F.collect_list(F.struct("cell", weight))).alias("weights"))
    return table  # at most SLOTS * CELLS cells for each of four kinds


def find(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``doc_id`` and ``spans`` of every row: ``kind, start, end, value, base, p`` by start, then kind."""
    found = scratch.table(candidates(docs), "candidates")
    spans = found.select(F.explode("spans").alias("x")).select("x.*")
    classifier = scratch.table(span_classifier(spans, reliabilities(spans)), "classifier")
    entries = F.map_from_entries(F.collect_list(F.struct("kind", F.struct("bias", "weights"))))
    model = classifier.agg(entries.alias("m")).scalar()

    def scored(x: Column) -> Column:
        own = F.element_at(F.col("_model"), x["kind"])
        z = F.aggregate(x["cells"], own["bias"], lambda acc, c: acc + F.coalesce(F.element_at(own["weights"], c), F.lit(0.0)))
        order = F.coalesce(*[F.when(x["kind"] == k, i) for i, k in enumerate(KINDS)])
        return F.struct(x["start"].alias("start"), order.alias("order"), x["end"].alias("end"), x["kind"].alias("kind"), x["value"].alias("value"),
                        x["base"].alias("base"), (1 / (1 + F.exp(-z))).alias("p"))

    with_model = found.withColumn("_model", model)
    kept = F.array_sort(F.filter(F.transform("spans", scored), lambda x: x["base"] | (x["p"] >= ACCEPT)))
    final = F.transform(kept, lambda x: F.struct(*[x[c].alias(c) for c in ("kind", "start", "end", "value", "base", "p")]))
    return with_model.select("doc_id", F.when(F.size("spans") > 0, final).otherwise(F.array()).alias("spans"))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find(docs, Scratch(spark, "pii"))
    base = F.filter("spans", lambda x: x["base"])
    count = lambda kind: F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
