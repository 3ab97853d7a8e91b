from __future__ import annotations

import random

from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import decontaminate

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def got(spark, docs, items):
    found = decontaminate.contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, ",".join(r["items"])) for r in found.collect()), key=str)


ODD_DOCS = [(1, "the cat the cat sat"), (1, "the cat the cat sat"), (None, None), (None, "A b c d e f g h i j k l m"), (3, ""), (4, "x y z the"), (5, "ab cd ef gh ij kl mn op")]
ODD_ITEMS = [(1, "the"), (2, "cat sat"), (None, "Y Z"), (3, "a b c d e f g h i j k"), (4, ""), (5, None), (1, "b c d e f g h i j k l m"), (6, "cd EF gh! ij, kl mn"), (6, "cd EF gh! ij, kl mn")]


def test_odd_rows(spark):
    assert got(spark, ODD_DOCS, ODD_ITEMS) == brute.contamination(ODD_DOCS, ODD_ITEMS)


def test_no_documents_or_no_items(spark):
    assert got(spark, [], ODD_ITEMS) == []
    assert got(spark, ODD_DOCS, []) == brute.contamination(ODD_DOCS, [])


def test_random_passages_and_a_hot_one(spark):
    pick = random.Random(4)
    word = lambda: f"w{pick.randrange(30)}"
    items = [(i, " ".join(word() for _ in range(pick.choice([1, 4, 9, 10, 11, 25, 40])))) for i in range(60) if i != 7] + [(7, " ".join(f"hot{i}" for i in range(30)))]
    docs = []
    for i in range(200):
        words = [word() for _ in range(pick.randrange(80))]
        if i % 3 == 0:
            words += items[-1][1].split()
        if i % 5 == 0:
            own = pick.choice(items)[1].split()
            start = pick.randrange(len(own))
            words[len(words) // 2 : len(words) // 2] = own[start : start + 15]
        docs.append((i, ", ".join(words)))
    docs.append((999, " ".join(word() for _ in range(30_000))))
    items = [x for x in items if len(x[1].split()) > 1]
    assert got(spark, docs, items) == brute.contamination(docs, items)


def test_stage_drops_only_contaminated_rows(spark):
    docs = spark.createDataFrame(ODD_DOCS, DOCS).withColumn("row", F.lit(1)).withColumn("text_key", F.lit("k"))
    kept = decontaminate.without_contaminated(docs, spark.createDataFrame(ODD_ITEMS, ITEMS))
    assert kept.columns == docs.columns
    assert brute.rows(kept, "doc_id", "text") == sorted([(None, None), (3, "")], key=str)
