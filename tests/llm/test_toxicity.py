from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import toxicity

SF = "/root/testdata/sf0.1"
SCHEMA = "doc_id long, text string"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit(docs, labels.where("doc_id % 3 <> 0"))
    held = toxicity.severities(docs, model).withColumnRenamed("toxic", "found").join(labels.where("doc_id % 3 = 0"), "doc_id")
    counts = {(r.toxic, r.found): r["count"] for r in held.groupBy("toxic", "found").count().collect()}
    found, missed = counts.get((1, True), 0), counts.get((1, False), 0)
    assert found / (found + missed) > 0.85
    assert counts.get((0, True), 0) / (counts[0, False] + counts.get((0, True), 0)) < 0.01
    means = [r.severity for r in held.groupBy("grade").agg(F.avg("severity").alias("severity")).orderBy("grade").collect()]
    assert len(means) == 4 and means == sorted(means)


def test_thresholds_are_ordered_and_shared():
    pick = np.random.default_rng(1)
    x = pick.integers(0, 4, size=(600, 3)).astype(float)
    grades = np.clip(np.floor(x[:, 0] - 0.2 + pick.normal(0, 0.1, 600)), 0, 3).astype(int)
    row, col = np.nonzero(x)
    weights, thresholds = toxicity.fit_ordinal(row, col, x[row, col], grades, 3, penalty=1e-4, rounds=3000)
    assert list(thresholds) == sorted(thresholds) and weights[0] > 5 * np.abs(weights[1:]).max()
    assert (sum((x @ weights >= t).astype(int) for t in thresholds) == grades).mean() > 0.9


def test_odd_rows(spark):
    pick = random.Random(1)
    words = [f"word{i}" for i in range(40)]
    rows = [(i, " ".join(pick.choices(words, k=30) + ["nasty"] * (i % 4 == 0) * 2)) for i in range(400)]
    odd = [(None, None), (None, "nasty nasty"), (1000, ""), (0, rows[0][1]), (1001, "nasty " * 20_000)]
    docs = spark.createDataFrame(rows + odd, SCHEMA).withColumn("score", F.lit(1)).withColumn("toxic", F.lit("t"))
    labels = [(i, int(i % 4 == 0)) for i in range(400)] + [(None, 1), (3, None), (0, 1), (5000, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in range(400) if i % 4} | {None, 1000}
    assert kept.where("doc_id is null").count() == 1
    for none in (toxicity.fit(docs, labels.limit(0)), toxicity.fit(docs.limit(0), labels), toxicity.fit(docs, labels.where("toxic = 1"))):
        assert toxicity.without_toxic(docs, none).count() == docs.count()
        assert {r.severity for r in toxicity.severities(docs, none).collect()} == {0.0}


def made(n=240):
    pick = random.Random(6)
    words = [f"word{i}" for i in range(25)] + ["Zürich", "nastily", "nasties"]
    rows = []
    for i in range(n):
        bad = ["nasty"] * pick.choice([1, 2, 7]) + ["vilest"] * pick.choice([0, 1, 3]) if i % 3 == 0 else ["nasty"] * (i % 29 == 1)
        rows.append((i, " ".join(pick.choices(words, k=pick.choice([3, 12, 30])) + bad)))
    return rows, [(i, int(i % 3 == 0)) for i in range(n)]


def test_weights_as_brute_force(spark):
    """The same weights, thresholds and severities from loops over dense rows."""
    rows, labels = made()
    docs = spark.createDataFrame(rows + [(0, "again " + rows[0][1]), (900, "nasty vilest")], SCHEMA)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    # Of the two texts of document 0 that with the smaller hash is fitted.
    zero = docs.where("doc_id = 0").orderBy(F.xxhash64(F.col("text").cast("binary"))).first().text
    weights, thresholds = brute.toxicity([(0, zero), *rows[1:]], dict(labels))
    assert model.weights.keys() == {f for f, w in weights.items() if abs(w) > 0} and len(model.weights) > 2
    assert all(abs(model.weights[f] - weights[f]) < 1e-6 for f in model.weights)
    assert np.allclose(model.thresholds, thresholds, atol=1e-6)
    for r in toxicity.severities(docs, model).where("doc_id > 0").collect():
        text = dict(rows).get(r.doc_id, "nasty vilest")
        score = sum(w * min(n, 5) for f, n in brute.toxic_features(text).items() if (w := weights.get(f)))
        assert abs(r.severity - sum(1 / (1 + np.exp(t - score)) for t in thresholds)) < 1e-6
        assert r.toxic == (score >= thresholds[0])


def test_the_sample_bounds_what_is_fitted(spark, monkeypatch):
    """Thousands of rows of one labelled id are one text of the sample."""
    seen = []
    real = toxicity.stage
    monkeypatch.setattr(toxicity, "stage", lambda df, label: seen.append(real(df, label)) or seen[-1])
    rows, labels = made()
    docs = spark.createDataFrame(rows, SCHEMA).unionByName(
        spark.range(5000).select(F.lit(3).cast("long").alias("doc_id"), F.concat(F.lit("nasty "), F.col("id").cast("string")).alias("text"))
    )
    toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), sample=100)
    assert [f.count() for f in seen] == [100]
