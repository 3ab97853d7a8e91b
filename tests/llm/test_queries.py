"""Registered queries against their SQL, and the pipeline against its operators' plain versions."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from tests.llm import brute
from tidemark.llm import queries

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def test_operators_are_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_query_matches_sql(spark, duck, key):
    theirs = duck.execute(queries.ORACLE[key])
    names = [d[0] for d in theirs.description]
    ours = queries.QUERIES[key](spark, SF)
    assert sorted(ours.columns) == sorted(names)
    got, want = Counter(tuple(r) for r in ours.select(*names).collect()), Counter(theirs.fetchall())
    assert sum(got.values()) > 0
    assert (got - want, want - got) == (Counter(), Counter())


def test_repeated_pages_are_all_judged_as_sql(spark, tmp_path):
    pages = [(1, "http://net/"), (1, "http://net/"), (1, "http://a.org/fr/x"), (None, None), (None, None)]
    spark.createDataFrame(pages, "page_id long, url string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    theirs = con.execute(queries.ORACLE["op3_url_filters"])
    names = [d[0] for d in theirs.description]
    ours = queries.QUERIES["op3_url_filters"](spark, str(tmp_path)).select(*names).collect()
    assert Counter(map(tuple, ours)) == Counter(theirs.fetchall()) and len(ours) == 5


def test_near_duplicates_of_the_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r.component_id for r in queries.QUERIES["op6_minhash_near_dedup"](spark, SF).collect()}
    assert got == brute.near_duplicates([(r.doc_id, r.text) for r in docs.collect()], 2)


def test_recall_of_neighbours(spark):
    import numpy as np

    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows])
    got = {}
    for r in queries.QUERIES["op10_nearest_neighbours"](spark, SF).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    shares = []
    for q in ids[ids % 100 == 0]:
        far = np.sqrt(((vectors - vectors[ids == q][0]) ** 2).sum(axis=1))
        near = [i for i in ids[np.lexsort((ids, far))] if i != q][:10]
        shares.append(len(got[q] & set(near)) / 10)
    assert np.mean(shares) >= 0.9


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = {r.doc_id: r.text for r in docs.collect()}
    frame, left = docs, set(texts)
    for name, function in corpus_pipeline.STAGES[:-1]:
        frame = function(spark, frame, SF).cache()
        assert frame.columns == docs.columns
        stay = {r.doc_id for r in frame.collect()}
        if name == "toxicity":
            clean = [i for i, toxic in labels.items() if not toxic]
            bad = [i for i, toxic in labels.items() if toxic]
            assert sum(i in stay for i in clean) >= 0.99 * len(clean)
            assert sum(i in stay for i in bad) <= 0.3 * len(bad)  # few labels at this size
        elif name == "near_dedup":
            groups = brute.near_duplicates([(i, texts[i]) for i in left], 5)
            assert stay == {i for i in left if groups[i] == i}
        else:
            assert stay == {r[0] for r in brute.contamination([(i, texts[i]) for i in left], items) if not r[2]}
        left = stay
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == left
