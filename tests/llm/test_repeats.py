from __future__ import annotations

import random

import numpy as np
import pytest

from tests.llm import brute
from tidemark.llm import repeats
from tidemark.llm.suffix import _by_doubling, permuted_prefixes, suffix_array


def cut(spark, docs, **options):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = repeats.without_repeats(df, **options).collect()
    return sorted(((r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in found), key=str)


@pytest.mark.parametrize("symbols", [1, 2, 3, 20, 300])
def test_suffix_arrays_and_common_prefixes(symbols):
    rng = random.Random(symbols)
    for _ in range(40):
        text = [rng.randrange(symbols) for _ in range(rng.randrange(150))]
        order = sorted(range(len(text)), key=lambda i: text[i:])
        assert suffix_array(np.array(text, dtype=np.int64)).tolist() == order
        ended = np.array([x + 1 for x in text] + [0])
        assert _by_doubling(ended).tolist() == [len(text), *order]
        for most in (3, 50):
            common = permuted_prefixes(np.array(text, dtype=np.int64), np.array(order, dtype=np.int64), most)
            for a, b in zip(order, order[1:], strict=False):
                same = next((k for k in range(most) if text[a + k : a + k + 1] != text[b + k : b + k + 1] or b + k >= len(text)), most)
                assert common[b] == same


def test_large_alphabets_sort_names_by_doubling_and_by_induction(monkeypatch):
    rng = np.random.default_rng(1)
    text = rng.integers(0, 4, 60_000)
    order = suffix_array(text)
    ranks = np.empty(len(text) + 1, dtype=np.int64)
    ranks[order], ranks[len(text)] = np.arange(len(text)), -1
    a, b = order[:-1], order[1:]
    assert ((text[a] < text[b]) | ((text[a] == text[b]) & (ranks[a + 1] < ranks[b + 1]))).all()


@pytest.mark.parametrize(
    ("length", "options"),
    [
        (50, {}),
        (50, {"hot": 3, "shard": 2_000, "block": 3_000}),
        (30, {"hot": 2, "shard": 500}),
        (100, {"hot": 5, "block": 1_000}),
    ],
)
def test_as_brute_force(spark, length, options):
    rng = random.Random(length + len(options))
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(400))) for _ in range(12)]
    docs = []
    for n in range(60):
        parts = [rng.choice(base) for _ in range(rng.randrange(4))]
        text = "".join(p[rng.randrange(len(p) + 1) :][: rng.randrange(300)] + rng.choice(["", "xyz", "q" * 70]) for p in parts)
        # Ids repeat and are missing; texts are null, empty and equal.
        docs.append((rng.choice([n, n, n, 5, None]), rng.choice([text, text, text, text, None, "", base[0]])))
    assert cut(spark, docs, length=length, **options) == brute.repeats(docs, length)


def test_periodic_and_long_texts(spark, monkeypatch):
    rng = random.Random(7)
    long = "".join(rng.choice("abcdefgh ") for _ in range(700_000))
    docs = [(1, "a" * 300_000), (2, long), (3, "b" + long[300_000:600_000] + "c"), (4, "a" * 60), (5, "ab" * 400), (6, long)]
    found = {r[0]: r for r in cut(spark, docs)}
    assert found[1][2] == found[2][2] == found[5][2] == []
    assert found[3][2] == [(1, 300_001)] and found[3][3] == b"bc"
    assert found[4][2] == [(0, 60)] and found[6][2] == [(0, 700_000)]


def test_judged_on_the_input(spark):
    """What is removed from one document still removes from others."""
    passage = "".join(chr(97 + i % 23) + chr(65 + i % 19) for i in range(40))
    docs = [(1, passage), (2, "x" + passage), (3, passage + "y")]
    assert [r[2] for r in cut(spark, docs)] == [[], [(1, 81)], [(0, 80)]]


def test_empty_and_extra_columns(spark):
    assert cut(spark, []) == []
    df = spark.createDataFrame([(1, "t", 5, "z")], "doc_id long, text string, block long, kept string")
    assert [r.n_bytes for r in repeats.without_repeats(df).collect()] == [1]
    with pytest.raises(ValueError, match="length"):
        repeats.without_repeats(df, length=10)
