"""Quotation linking: conversations in reply order, with the quotes taken out.

A line's quote level is the number of ``>`` it begins with. Lines of one level that follow each other are
a passage; level 0 is a message's own text, and a line that announces a quote ("... wrote:") right before
one belongs to neither. A passage is normalised (white space to one blank, lower case) and hashed whole,
by paragraph and by line. So is every message's own text, and the original of a hash is the earliest
message of the conversation that has it as text of its own. A quote is linked to that original if it is
earlier than the quoting message; the whole passage counts before its paragraphs, a paragraph before its lines, so
that a passage which quotes several messages is linked to each. Of
the levels that are linked, the lowest is what a message replies to; of several originals there, the latest is its parent.

Messages are ordered by thread (the message that a chain of replies goes back to), then by turn. Chains
are followed by doubling, one join per doubling, over linked messages only. Everything is DataFrame
operations; groupings are a minimum per hash, which combines before its shuffle, and the originals of a message's own
quotes, so a conversation or a text that makes up much of the table is not gathered anywhere.

Null text counts as empty. A message without conversation or turn is kept, unlinked and without a thread. Rows that
repeat a turn are versions of one message: each has its own links; what others quote leads to the turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.shared import stage

_MARKS = r"^(?:[ \t]*>)*"
_ANNOUNCES = r"(?i)^.{0,300}\b(?:wrote|writes|said|schrieb|a écrit|escribió)\b.{0,100}:\s*$"
_MARK = "\u0001"
WHOLE, PARAGRAPH, LINE = 0, 1, 2


def normal(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def _passages(text: Column) -> Column:
    """Array of (level, text): runs of lines with the same level; announcing lines have level -1."""
    return F.transform(
        F.split(text, "\r\n|\r|\n"),
        lambda line: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 0), "[^>]", "")).alias("level"),
            F.regexp_replace(line, r"^(?:[ \t]*>)+[ \t]?", "").alias("body"),
        ),
    )


def parsed(messages: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Per message row: conv, turn, role, key (of the text), own (text without quotes), quotes (level, text)."""
    base = messages.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.col(role_col).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    lines = base.select("*", _passages(F.col("text")).alias("lines"))
    next_level = lambda i: F.get("lines", i + 1)["level"]
    announced = lambda line, i: (line["level"] == 0) & F.coalesce(next_level(i) > 0, F.lit(False)) & line["body"].rlike(_ANNOUNCES)
    levelled = F.transform(
        "lines", lambda line, i: F.struct(F.when(announced(line, i), -1).otherwise(line["level"]).alias("level"), line["body"].alias("body"))
    )
    lines = lines.select("conv", "turn", "role", F.xxhash64("text").alias("key"), levelled.alias("lines"))
    # One text with a mark before each run, split at the marks: slices of an array would copy it for every run.
    # A mark is a character that is doubled with a 0 wherever a line has it.
    escaped = lambda text: F.replace(text, F.lit(_MARK), F.lit(_MARK + "0"))
    start = lambda line, i: (i == 0) | (line["level"] != F.get("lines", i - 1)["level"])
    head = lambda line: F.concat(F.lit(_MARK + "1"), line["level"].cast("string"), F.lit(_MARK + "2"))
    marked = F.transform("lines", lambda line, i: F.concat(F.when(start(line, i), head(line)).otherwise("\n"), escaped(line["body"])))
    lines = lines.select("conv", "turn", "role", "key", F.array_join(marked, "").alias("marked"))
    parts = F.transform(F.slice(F.split("marked", _MARK + "1"), 2, 1 << 30), lambda r: F.split(r, _MARK + "2", 2))
    runs = F.transform(
        parts, lambda r: F.struct(r[0].cast("int").alias("level"), F.replace(r[1], F.lit(_MARK + "0"), F.lit(_MARK)).alias("text"))
    )
    runs = lines.select("conv", "turn", "role", "key", runs.alias("runs"))
    bodies = F.transform(F.filter("runs", lambda r: r["level"] == 0), lambda r: r["text"])
    quotes = F.filter("runs", lambda r: (r["level"] > 0) & (F.length(normal(r["text"])) > 0))
    return runs.select("conv", "turn", "role", "key", F.regexp_replace(F.array_join(bodies, "\n"), r"^\s+|\s+$", "").alias("own"), bodies.alias("bodies"), quotes.alias("quotes"))


def _hash(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def _hashes(text: Column) -> Column:
    """Distinct units of a passage, its paragraphs and their lines: grain, hash of the paragraph of a line or paragraph, hash.

    As texts, which Spark tells apart by hashing; structs it would compare one by one."""
    unit = lambda grain, paragraph, hashed: F.concat(F.lit(str(grain)), paragraph, hashed)
    # A paragraph is hashed once, not for each of its lines.
    paragraphs = F.transform(F.split(text, r"\n\s*\n"), lambda p: F.struct(_unit_hash(p).alias("hash"), F.split(p, "\n").alias("lines")))
    lines = F.flatten(F.transform(paragraphs, lambda p: F.transform(p["lines"], lambda x: unit(LINE, p["hash"], _unit_hash(x)))))
    whole = F.array(unit(WHOLE, F.lit(""), _unit_hash(text)))
    units = F.concat(whole, F.transform(paragraphs, lambda p: unit(PARAGRAPH, p["hash"], p["hash"])), lines)
    return F.array_distinct(F.filter(units, lambda u: u.isNotNull()))


def _unit_hash(text: Column) -> Column:
    """Of the normalised text; null if nothing is left of it."""
    return _hash(F.nullif(normal(text), F.lit("")))


def _unit_parts(unit: Column) -> list[Column]:
    paragraph = F.when(F.length(unit) > 33, F.substring(unit, 2, 32))
    return [F.substring(unit, 1, 1).cast("int").alias("grain"), paragraph.alias("paragraph"), F.right(unit, F.lit(32)).alias("hash")]


def linked(messages: DataFrame) -> DataFrame:
    """Per quoted passage of a parsed message that has an original: conv, turn, key, passage, level, originals."""
    able = messages.where(F.col("conv").isNotNull() & F.col("turn").isNotNull())
    quoted = (
        able.where(F.size("quotes") > 0)
        .select("conv", "turn", "key", F.posexplode("quotes").alias("passage", "quote"))
        .select("conv", "turn", "key", "passage", "quote.level", F.explode(_hashes(F.col("quote.text"))).alias("unit"))
        .select("conv", "turn", "key", "passage", "level", *_unit_parts(F.col("unit")))
    )
    own = F.array_distinct(
        F.flatten(F.transform(F.array_union(F.array("own"), F.col("bodies")), lambda t: F.transform(_hashes(t), lambda u: F.right(u, F.lit(32)))))
    )
    original = able.select("conv", "turn", F.explode(own).alias("hash")).groupBy("conv", "hash").agg(F.min("turn").alias("original"))
    found = quoted.join(original, ["conv", "hash"]).where(F.col("original") < F.col("turn"))
    passage = ["conv", "turn", "key", "passage", "level"]
    # The whole passage has no paragraph and is a group of its own.
    parts = found.groupBy(*passage, "paragraph").agg(
        F.min("grain").alias("grain"),
        F.min(F.when(F.col("grain") < LINE, F.col("original"))).alias("one"),
        F.collect_set(F.when(F.col("grain") == LINE, F.col("original"))).alias("of_lines"),
    )
    part = F.when(F.col("grain") < LINE, F.array("one")).otherwise(F.col("of_lines"))
    whole = F.min(F.when(F.col("grain") == WHOLE, F.col("one")))
    each = F.array_distinct(F.flatten(F.collect_list(part)))
    return parts.groupBy(*passage).agg(F.when(whole.isNotNull(), F.array(whole)).otherwise(each).alias("originals"))


def threads(parents: DataFrame) -> DataFrame:
    """(conv, turn, parent) to (conv, turn, thread, depth): the end of the chain and how far it is."""
    chains = stage(parents.select("conv", "turn", F.col("parent").alias("thread"), F.lit(1).alias("depth")), "chains")
    while True:
        ahead = chains.select("conv", F.col("turn").alias("thread"), F.col("thread").alias("further"), F.col("depth").alias("more"))
        if chains.join(ahead, ["conv", "thread"], "left_semi").isEmpty():
            return chains
        chains = chains.join(ahead, ["conv", "thread"], "left").select(
            "conv",
            "turn",
            F.coalesce("further", "thread").alias("thread"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
        )
        chains = stage(chains, "chains")


def conversations(
    messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Per message row, in reply order: ids, role, text without quotes, what it replies to, its thread, the chat markup."""
    rows = stage(parsed(messages, conv_col, turn_col, role_col, text_col), "messages")
    links = stage(linked(rows), "links")
    lowest = links.groupBy("conv", "turn", "key").agg(F.min("level").alias("level"), F.count("*").alias("n_linked"))
    replies = links.join(lowest, ["conv", "turn", "key", "level"])
    replies = replies.groupBy("conv", "turn", "key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("originals")))).alias("replies_to"), F.first("n_linked").alias("n_linked")
    )
    replies = stage(replies, "replies")
    parents = replies.groupBy("conv", "turn").agg(F.max(F.array_max("replies_to")).alias("parent"))
    ordered = rows.join(replies, ["conv", "turn", "key"], "left").join(threads(parents), ["conv", "turn"], "left")
    role = F.coalesce("role", F.lit("unknown"))
    thread = F.when(F.col("conv").isNotNull(), F.coalesce("thread", "turn"))
    none = F.array().cast(messages.select(F.array(turn_col)).dtypes[0][1])
    return ordered.select(
        F.col("conv").alias(conv_col),
        F.col("turn").alias(turn_col),
        F.col("role").alias(role_col),
        F.col("own").alias(text_col),
        thread.alias("thread"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
        F.array_max("replies_to").alias("reply_to"),
        F.coalesce("replies_to", none).alias("replies_to"),
        F.size("quotes").cast("long").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        F.concat(F.lit("<|"), role, F.lit("|>\n"), F.col("own"), F.lit("\n")).alias("formatted"),
    ).orderBy(conv_col, "thread", turn_col)
