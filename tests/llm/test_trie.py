from __future__ import annotations

import random

import numpy as np
import pytest

from tests.llm import brute
from tidemark.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def nodes(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA)
    return brute.rows(trie.prefix_trie(*trie.rebuilt(trie.numbered(frame)), **options), *NAMES)


def made(seed, convs=60):
    rng = random.Random(seed)
    out = []
    for c in [*range(convs), 1 << 40, -7, None]:
        for turn in range(rng.choice([1, 2, 5, 12])):
            number = rng.choice([turn, turn, turn, None, 3])
            out.append((c, number, rng.choice(["user", "user", None, "bot"]), rng.choice(["hi", "é", "", None, "x" * 20])))
    return out


@pytest.mark.parametrize("options", [{"stretch": 2, "range_": 3, "shard": 5}, {"stretch": 3, "range_": 1, "shard": 40}])
def test_as_brute_force(spark, options):
    # Missing and repeated turns included; negative ids are left out, as Python divides them otherwise.
    rows = [r for r in made(options["stretch"]) if r[0] is None or r[0] >= 0]
    assert nodes(spark, rows, **options) == brute.trie(rows)


def test_one_conversation_holds_most_turns(spark):
    rng = random.Random(2)
    long = [(10, t, "user", rng.choice(["a", "b"])) for t in range(700)]
    rows = [*long, *((11, t, r, x) for _, t, r, x in long[:600]), *((12, t, r, x) for _, t, r, x in long), (13, 0, "user", "a")]
    assert nodes(spark, rows, stretch=50, range_=120, shard=10) == brute.trie(rows)


def test_many_copies_of_one_conversation(spark):
    rows = [(c, t, "user", "same") for c in range(0, 1500, 5) for t in range(3)]
    got = nodes(spark, rows)
    assert got == brute.trie(rows)
    assert {r[3] for r in got} == {300}


def test_without_turns_and_empty_tables(spark):
    assert nodes(spark, []) == []
    rows = [(c, 0, "user", f"t{c}") for c in (1, 2, 3, 4)]  # no base, and what remains of most is nothing
    got = nodes(spark, rows)
    assert got == brute.trie(rows)
    assert got[0][1] == 0 and got[0][3] == 4


def test_other_columns_do_no_harm(spark):
    rows = [(*r, "x", 1) for r in made(9, 20) if r[0] is not None and r[0] >= 0]
    frame = spark.createDataFrame(rows, SCHEMA + ", k1 string, depth int")
    got = brute.rows(trie.prefix_trie(*trie.rebuilt(trie.numbered(frame))), *NAMES)
    assert got == brute.trie([r[:4] for r in rows])


def test_perfect_hash_is_minimal_and_knows_its_keys():
    rng = np.random.default_rng(4)
    k1, k2 = rng.integers(0, 1 << 60, 5_000), rng.integers(0, 50, 5_000)
    table = trie.PerfectHash(k1, k2)
    assert sorted(table.find(k1, k2).tolist()) == list(range(5_000))
    assert (table.find(k1 + 1, k2) == -1).all()
    with pytest.raises(ValueError, match="repeat"):
        trie.PerfectHash(np.array([1, 1]), np.array([2, 2]))


def test_a_clash_of_digests_stops_the_run(spark, monkeypatch):
    from pyspark.sql import functions as F

    weak = lambda: [F.lit(1).cast("long"), F.lit(2).cast("long"), F.crc32(F.col("text").cast("binary"))]
    monkeypatch.setattr(trie, "_turn_hashes", weak)
    with pytest.raises(Exception, match="share a digest"):
        nodes(spark, [(5, 0, "user", "a"), (10, 0, "user", "b"), (15, 0, "user", "c")])
