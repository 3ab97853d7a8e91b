from __future__ import annotations

import random

import numpy as np
import pytest

from tests.llm import brute
from tidemark.llm import phrases


def mined(spark, docs, **options):
    return brute.rows(phrases.collocations(spark.createDataFrame(docs, "lang string, text string"), **options))


def made(seed, rows=150):
    rng = random.Random(seed)
    common = ["new York", "in\tthe end of", "point of view", "zürich see", "of the"]
    out = []
    for _ in range(rows):
        parts = [rng.choice([*common, *"abcdefg", "Of", " x", "é"]) + rng.choice([" ", "  ", "\t", ", ", ".", "\n", ": "]) for _ in range(30)]
        text = rng.choice(["".join(parts)] * 5 + [None, "", " .,"])
        out.append((rng.choice(["en", "en", "en", "de", None, "und", ""]), text))
    return out


@pytest.mark.parametrize("shard", [500, 1 << 20])
@pytest.mark.parametrize("support", [2, 12])
def test_as_brute_force(spark, shard, support):
    """Shards so small that the lowered support is 1, and so large that it is not."""
    docs = made(shard + support)
    want = brute.collocations(docs, support, 40)
    assert len(want) > 15
    assert mined(spark, docs, support=support, best=40, shard=shard) == want


def test_one_group_holds_nearly_all(spark):
    docs = [("en", "big red dog. big red dog")] * 400 + [("de", "ja nein")]
    got = mined(spark, docs, support=30, best=10, shard=600)
    assert got == brute.collocations(docs, 30, 10)
    assert [r[2:7] for r in got] == [("big red dog", 800, 800, 800, 2400)]


def test_long_texts_are_cut_between_pieces(spark):
    rng = random.Random(5)
    long = " ".join(rng.choice(["a b", "c d e", "f.", "g,"]) for _ in range(20_000))
    unbroken = "x y " * 600_000  # one piece, longer than a slice
    docs = [("en", long), ("fr", unbroken)]
    assert mined(spark, docs, shard=3_000) == brute.collocations(docs, 30, 2000)


def test_empty_tables_ties_and_other_columns(spark):
    assert mined(spark, []) == []
    assert mined(spark, [("en", None), (None, "")]) == []
    df = spark.createDataFrame([("en", "b c. a d", 1, "x")] * 30, "lang string, text string, rank int, phrase string")
    assert [r.phrase for r in phrases.collocations(df).orderBy("rank").collect()] == ["a d", "b c"]


def test_hashes_do_not_depend_on_the_slice():
    texts = [b"one Two three", b"two\tthree. one"]
    whole = phrases.Words(texts, with_text=True)
    assert whole.left.tolist() == [3, 2, 1, 2, 1, 1]
    assert (whole.hash[[1, 2, 0]] == whole.hash[[3, 4, 5]]).all()
    assert whole.texts(np.array([0, 3]), 2).to_pylist() == ["one two", "two three"]


def test_exact_beyond_64_bits(spark):
    """The product of the scale and the number of places is taken in 38 digits."""
    docs = [("en", "a b")] * 40
    got = mined(spark, docs, scale=10**18)
    assert got == [("en", 1, "a b", 40, 40, 40, 80, 5 * 10**17)]
