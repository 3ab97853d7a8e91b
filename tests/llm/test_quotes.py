from __future__ import annotations

from collections import Counter

import duckdb
from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import queries, quotes

SCHEMA = "conv_id long, turn long, role string, text string"
CONVERSATION = [
    (1, 0, "user", "Hello there.\nHow are you?\n\nSecond para here."),
    (1, 1, "assistant", "On Monday, Bob wrote:\n> how are  YOU?\n\nFine, thanks.\nAnd you?"),
    (1, 2, "user", "> > How are you?\n> Fine, thanks.\n> And you?\nGood!"),
    (1, 3, "user", "New topic"),
    (1, 4, "assistant", "> Second para here.\nsure"),
    (1, 5, "x", ">New topic\n>> nothing known\nyes"),
    (1, 6, "user", "> Good!\n\n> New topic\nboth"),
    (2, 0, "user", "> Good!\nother conversation"),
    (3, 0, "user", "later"),
    (3, 1, "user", "> not said yet\nfirst"),
    (3, 2, "user", "not said yet"),
]


def test_links_threads_and_own_text(spark):
    found = quotes.conversations(spark.createDataFrame(CONVERSATION, SCHEMA).withColumn("own", F.lit(0)))
    got = {(r.conv_id, r.turn): r for r in found.collect()}
    assert {k: r.replies_to for k, r in got.items() if r.replies_to} == {(1, 1): [0], (1, 2): [1], (1, 4): [0], (1, 5): [3], (1, 6): [2, 3]}
    assert got[1, 1].text == "Fine, thanks.\nAnd you?" and got[1, 2].text == "Good!"
    assert (got[1, 2].thread, got[1, 2].depth, got[1, 2].n_quotes, got[1, 2].n_linked) == (0, 2, 2, 2)
    assert (got[1, 6].reply_to, got[1, 6].thread) == (3, 3)
    assert [r.turn for r in found.collect() if r.conv_id == 1] == [0, 1, 2, 4, 3, 5, 6]
    assert got[1, 3].formatted == "<|user|>\nNew topic\n"


SEVERAL = [
    (1, 0, "user", "Zero."),
    (1, 1, "user", "Para one.\n\nTail of one."),
    (1, 2, "user", "Two."),
    (1, 3, "user", "Para three,\nsecond line."),
    (1, 4, "user", "> Para one.\n>\n> Para three,\n> second line.\nboth"),
    (1, 5, "user", "> Para one.\n>\n> unknown\n> Two.\n>\n> Zero.\n> second line.\nlines of paragraphs without an original"),
    (1, 6, "user", "> Para one.\n>\n> Tail of one.\nthe whole only"),
    (1, 7, "user", "> Para one.\n>\n> Para one.\n>\n> not\n> known\n>> Two.\nonly once, and the lowest level"),
]


def test_a_passage_that_quotes_several_messages(spark):
    rows = SEVERAL
    got = {r.turn: r for r in quotes.conversations(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {k: r.replies_to for k, r in got.items() if r.replies_to} == {4: [1, 3], 5: [0, 1, 2, 3], 6: [1], 7: [1]}
    assert (got[4].reply_to, got[4].thread, got[4].depth, got[4].n_quotes, got[4].n_linked) == (3, 3, 1, 1, 1)
    assert [got[k].n_linked for k in (5, 6, 7)] == [1, 1, 2]


def test_long_chain_and_hot_text(spark):
    rows = [(1, 0, "user", "line 0")] + [(1, i, "user", f"> line {i - 1}\nline {i}") for i in range(1, 40)]
    rows += [(2, i, "user", "ok" if i % 2 else "> ok\nfine") for i in range(1, 300)]
    got = {(r.conv_id, r.turn): r for r in quotes.conversations(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (got[1, 39].thread, got[1, 39].depth, got[1, 39].reply_to) == (0, 39, 38)
    assert {got[2, i].reply_to for i in range(2, 300, 2)} == {1}


def test_nulls_repeats_and_nothing(spark):
    rows = [(None, 1, "user", "> a\nb"), (1, None, "user", "> a"), (1, 0, None, None), (1, 1, "user", ""), (1, 1, "user", ""), (1, 2, "user", ">")]
    found = quotes.conversations(spark.createDataFrame(rows, SCHEMA))
    assert found.count() == len(rows) and not any(r.replies_to for r in found.collect())
    assert quotes.conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_texts_without_quotes_stay(spark):
    rows = [(1, 0, "user", "a > b\n  c"), (1, 1, "user", "He wrote:\nno quote")]
    got = brute.rows(quotes.conversations(spark.createDataFrame(rows, SCHEMA)), "turn", "text")
    assert got == [(0, "a > b\n  c"), (1, "He wrote:\nno quote")]


def test_made_conversations_as_sql(spark, tmp_path):
    extra = [(4, i, "user", "".join(f"> {'> ' * (j % 3)}w{(i * 5 + j) % 7}\n" for j in range(i % 4)) + f"w{i % 7}\n\nw{i * 3 % 7}") for i in range(40)]
    extra += [(5, *row[1:]) for row in SEVERAL]
    extra += [(6, 0, "u", "a\u0001b\n\u00010c"), (6, 1, "u", "> a\u0001b\n>> \u00010c\n> a\u0001b\n\u00011 d"), (6, 2, "u", "> \u00011 d\n\u00012")]
    spark.createDataFrame(CONVERSATION + extra, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    theirs = con.execute(queries.ORACLE["op2_quotation_linking"])
    names = [d[0] for d in theirs.description]
    found = queries.QUERIES["op2_quotation_linking"](spark, str(tmp_path))
    assert Counter(tuple(r) for r in found.select(*names).collect()) == Counter(theirs.fetchall())


def test_time_grows_with_the_lines_of_a_message(spark):
    """Two messages, the second of which quotes every line of the first; levels that change with every line."""
    import time

    def took(n):
        lines = [f"line number {i}" for i in range(n)]
        rows = [(1, 0, "user", "\n".join(lines)), (1, 1, "user", "\n".join("> " + x for x in lines) + "\nmine")]
        rows += [(2, 0, "user", "\n".join("> " * (i % 3) + x for i, x in enumerate(lines)))]
        frame = spark.createDataFrame(rows, SCHEMA).coalesce(1)
        began = time.perf_counter()
        got = {(r.conv_id, r.turn): r for r in quotes.conversations(frame).collect()}
        assert got[1, 1].replies_to == [0] and got[1, 1].text == "mine"
        assert got[2, 0].n_quotes == sum(i % 3 > 0 for i in range(n))
        return time.perf_counter() - began

    took(200)
    short, long = min(took(20_000) for _ in range(2)), took(40_000)
    assert long <= 2.5 * short + 2
