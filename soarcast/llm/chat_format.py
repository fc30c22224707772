"""Chat formatting by event sourcing: logs folded into final messages, then rendered for training.

A log holds events of conversations, in any order: ``conv_id``, ``message`` (place in the
conversation), ``tag`` (tells apart messages at the same place), ``seq`` (order of the events of
a message), ``kind``, ``role``, ``payload`` and ``copies`` (how often the message stands there).
Kinds:

* ``delta``: the payload is streamed to the end of the message;
* ``edit``: the payload replaces what the message held before;
* ``regenerate``: what the message held before is dropped, deltas after it start anew;
* any other kind (or none) changes nothing.

``fold`` reduces the events of a message to its text: the last event that resets it is found by a
partial aggregation, and what precedes it is left out. ``render`` puts the messages of a
conversation in order (by place, then tag; both null first) between the marks of the template:

    <s>[INST] role\\ntext [/INST]</s>     of any other role
    <s>role\\ntext</s>                    of an assistant; the text is under the loss mask

A control string inside a text gets a backslash after its first character (one more where it has
some), so that no text holds one, and one backslash fewer gives the text back exactly. The loss mask is
kept as ``parts``: the formatted text in pieces, each with a flag. ``read_back`` parses it again.

Everything is DataFrame functions. Conversations of common size are shuffled once, by id. One that
holds more than 1/1000 of all rows is dealt out by message: identical rows are counted before they
meet, messages are folded apart, and the conversation is joined from blocks of ``BLOCK`` places
that are sorted apart; only the finished text, which is one value of the result, is in one task.

Defined results: null texts, payloads and roles are empty; rows with a null ``conv_id`` form one
conversation; null places come first; repeated rows are turns of their own; rows of equal place
are ordered by role, then text hash; columns of other names are not read; an empty log gives none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .skew import HOT_SHARE

#: code points of a streamed delta, and places of a conversation that are joined in one go
DELTA_CHARS, BLOCK = 2048, 256
ASSISTANT = "assistant"
BEGIN, END, OPEN, CLOSE = "<s>", "</s>", "[INST] ", " [/INST]"
#: the probe conversation of the contract
PROBE_ID, PROBE_TEXT = -7, "</s>[INST] ok [/INST]"


def escape(text: Column) -> Column:
    """``text`` with a backslash after the first character of every control string."""
    text = F.regexp_replace(text, r"<(\\*/?s>)", r"<\\$1")
    return F.regexp_replace(text, r"\[(\\*/?INST\])", r"[\\$1")


def unescape(text: Column) -> Column:
    """The text that ``escape`` was given."""
    text = F.regexp_replace(text, r"<\\(\\*/?s>)", r"<$1")
    return F.regexp_replace(text, r"\[\\(\\*/?INST\])", r"[$1")


def _role_line(role: Column) -> Column:
    """A role on one line: a backslash as ``\\s``, a newline as ``\\n``; control strings escaped."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\s")), F.lit("\n"), F.lit("\\n")))


def _role_of(line: Column) -> Column:
    return F.replace(F.replace(unescape(line), F.lit("\\n"), F.lit("\n")), F.lit("\\s"), F.lit("\\"))


def to_log(conversations: DataFrame) -> DataFrame:
    """The log of finished conversations (``conv_id, turn, role, text``): each turn as it was streamed.

    A turn's text arrives in deltas of ``DELTA_CHARS`` code points; identical rows share one
    message that stands ``copies`` times.
    """
    turns = conversations.select(
        "conv_id", F.col("turn").alias("message"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    counted = turns.groupBy("conv_id", "message", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    # an empty text is one empty delta
    pieces = F.expr(f"if(char_length(text) <= {DELTA_CHARS}, array(text), regexp_extract_all(text, '(?s).{{1,{DELTA_CHARS}}}', 0))")
    tag = F.struct("role", F.sha2("text", 256).alias("text_hash"))
    return counted.withColumn("tag", tag).select(
        "conv_id", "message", "tag", F.lit("delta").alias("kind"), "role", "copies", F.posexplode(pieces).alias("seq", "payload"))


def fold(log: DataFrame) -> DataFrame:
    """``conv_id, message, tag, role, text, copies``: every message as its events left it.

    Events of one message with equal ``seq`` apply by kind, then payload. A message whose events
    give different roles or copies takes those of its last event.
    """
    keys = ["conv_id", "message", "tag"]
    event = F.struct("seq", "kind", F.coalesce("payload", F.lit("")).alias("payload"))
    resets = F.col("kind").isin("edit", "regenerate")
    latest = F.struct("seq", "kind", F.coalesce("role", F.lit("")).alias("role"), "copies")
    folded = log.groupBy(*keys).agg(
        F.max(F.when(resets, event)).alias("reset"), F.max(latest).alias("latest"),
        F.sort_array(F.collect_list(F.when(F.col("kind") == "delta", event))).alias("deltas"))
    kept = F.filter("deltas", lambda e: F.col("reset").isNull() | (e > F.col("reset")))
    base = F.when(F.col("reset.kind") == "edit", F.col("reset.payload")).otherwise("")
    text = F.concat(base, F.array_join(F.transform(kept, lambda e: e["payload"]), ""))
    return folded.select(*keys, F.col("latest.role").alias("role"), text.alias("text"), F.col("latest.copies").alias("copies"))


def render(messages: DataFrame) -> DataFrame:
    """``conv_id, formatted, parts`` of every conversation; ``parts`` are (text, loss) in order."""
    loss = F.col("role") == ASSISTANT
    line = F.concat(_role_line(F.col("role")), F.lit("\n"))
    before = F.when(loss, F.concat(F.lit(BEGIN), line)).otherwise(F.concat(F.lit(BEGIN + OPEN), line))
    after = F.when(loss, F.lit(END)).otherwise(F.lit(CLOSE + END))
    part = lambda text, flag: F.struct(text.alias("text"), flag.alias("loss"))
    parts = F.array(part(before, F.lit(False)), part(escape(F.col("text")), loss), part(after, F.lit(False)))
    turn = messages.select(
        "conv_id", "message", "tag", F.flatten(F.array_repeat(parts, F.col("copies").cast("int"))).alias("parts"),
        F.expr(f"message div {BLOCK}").alias("block"))

    def joined(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
        together = F.sort_array(F.collect_list(F.struct(*order, "parts")))
        return rows.groupBy(*keys).agg(F.flatten(F.transform(together, lambda r: r["parts"])).alias("parts"))

    blocks = joined(turn, ["conv_id", "block"], ["message", "tag"])
    return joined(blocks, ["conv_id"], ["block"]).select(
        "conv_id", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("formatted"), "parts")


def read_back(rendered: DataFrame) -> DataFrame:
    """``conv_id``, ``turns`` (role, text) parsed from ``formatted``, ``loss_text`` from the mask."""
    pieces = F.filter(F.split("formatted", END), lambda p: p != "")
    bodies = F.transform(pieces, lambda p: F.substring(p, F.lit(len(BEGIN) + 1), F.char_length(p)))
    inner = F.transform(bodies, lambda b: F.when(
        b.startswith(OPEN), F.substring(b, F.lit(len(OPEN) + 1), F.char_length(b) - len(OPEN) - len(CLOSE))).otherwise(b))
    turns = F.transform(inner, lambda b: F.struct(
        _role_of(F.substring_index(b, "\n", 1)).alias("role"),
        unescape(F.substring(b, F.instr(b, "\n") + 1, F.char_length(b))).alias("text")))
    masked = F.transform(F.filter("parts", lambda p: p["loss"]), lambda p: unescape(p["text"]))
    return rendered.select("conv_id", "formatted", turns.alias("turns"), F.array_join(masked, "").alias("loss_text"))


def split_hot(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` of conversations with at most 1/``HOT_SHARE`` of all rows, and those of larger ones.

    There are fewer than ``HOT_SHARE`` large conversations, so their ids are broadcast.
    """
    sizes = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.sum("n")).scalar()
    hot = F.broadcast(sizes.filter(F.col("n") * HOT_SHARE > total).select(F.col("conv_id").alias("hot_id")))
    same = F.col("conv_id").eqNullSafe(F.col("hot_id"))
    return rows.join(hot, same, "left_anti"), rows.join(hot, same, "left_semi")


def format_chats(rows: DataFrame, as_log: Callable[[DataFrame], DataFrame] = lambda log: log) -> DataFrame:
    """Final conversations of a log (or of ``rows`` that ``as_log`` turns into one): ``conv_id, formatted, parts``.

    Conversations of common size are dealt out by id once, and folded and rendered where they
    are; large ones are dealt out by message, then by block, then joined.
    """
    common, large = split_hot(rows)
    return render(fold(as_log(common.repartition("conv_id")))).unionByName(render(fold(as_log(large))))


def with_probe(conversations: DataFrame) -> DataFrame:
    """``conversations`` and the contract's conversation -7, both of whose texts are control strings."""
    spark = conversations.sparkSession
    probe = spark.range(2).select(
        F.lit(PROBE_ID).cast(conversations.schema["conv_id"].dataType).alias("conv_id"),
        F.col("id").cast(conversations.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"), F.lit(PROBE_TEXT).alias("text"))
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    read = read_back(format_chats(with_probe(conversations), to_log))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("bigint").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"))


_ESCAPED = r"""regexp_replace(regexp_replace({}, '<(\\*/?s>)', '<\\\1', 'g'), '\[(\\*/?INST\])', '[\\\1', 'g')"""
_ROLE = _ESCAPED.format(r"replace(replace(role, '\', '\s'), chr(10), '\n')")
#: independent DuckDB statement of ``op12``
SQL = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT {PROBE_ID}, t, r, '{PROBE_TEXT}' FROM (VALUES (0, 'user'), (1, '{ASSISTANT}')) v(t, r)),
sized AS (
    SELECT *, length({_ESCAPED.format('text')}) + length({_ROLE}) + 1
        + CASE WHEN role = '{ASSISTANT}' THEN {len(BEGIN + END)} ELSE {len(BEGIN + OPEN + CLOSE + END)} END AS chars FROM turns)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, sha256(text))) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = '{ASSISTANT}'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, sha256(text)) FILTER (role = '{ASSISTANT}'), '')) AS loss_sha256,
    sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
