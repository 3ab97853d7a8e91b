"""Toxicity as a severity from 0 to 3, by cumulative-link ordinal regression over sparse text features.

Features are the words of a text (letters, digits and all non-ASCII, A-Z lower-cased) and the beginnings
of its words, each with its count up to 5. Labels only say whether a text is toxic, so a toxic text is
graded 1 to 3 by how much it has of the features that are far more frequent in toxic texts: the thirds of
the labelled toxic texts. A text labelled as clean has grade 0.

One weight per feature is shared by all ordered thresholds: P(grade > k) = sigmoid(w.x - theta_k). The
expected severity is the sum of these three; a text is rejected if P(grade > 0) is at least one half.

The model is fitted on the ``SAMPLE`` labelled documents with the smallest hash of their id (all, if
fewer); counting features is a Spark job, and only features that tell the classes apart are collected.
Scoring reads every document whole. Null text counts as empty; a label whose id or toxic value is null, or
that has no document, is left out; rows that repeat an id in the labels count once, as toxic if any is. With
no toxic or no clean label nothing is rejected.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import alnum_words, ready_for_python
from tidemark.sources.shared import stage

SAMPLE = 20_000
BEGINNINGS = (5, 6, 7, 8, 9, 10, 12)  # in bytes
MOST = 5.0  # of a feature's count
LEAST_TEXTS, LEAST_Z, MARKED_ODDS = 5, 5.0, 20.0
PENALTY, ROUNDS = 3e-4, 8000


def features(raw: bytes) -> Counter:
    """Counts of words and of beginnings of longer words; no word has a ``*``."""
    found: Counter = Counter()
    for word, times in Counter(alnum_words(raw)).items():
        found[word] += times
        for size in BEGINNINGS:
            if len(word) > size:
                found[word[:size] + b"*"] += times
    return found


@dataclass(frozen=True)
class Model:
    weights: dict[bytes, float]
    thresholds: tuple[float, float, float]

    def score(self, text: Column) -> Column:
        """The latent score w.x of a text column."""
        weights = self.weights
        stems = {f.rstrip(b"*")[: BEGINNINGS[0]] for f in weights}

        def of_text(raw: bytes) -> float:
            found: Counter = Counter()
            for word, times in Counter(alnum_words(raw)).items():
                if word[: BEGINNINGS[0]] in stems:
                    for feature in (word, *(word[:k] + b"*" for k in BEGINNINGS if len(word) > k)):
                        if feature in weights:
                            found[feature] += times
            return sum(weights[f] * min(n, MOST) for f, n in sorted(found.items()))

        @F.pandas_udf("double")
        def score_texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                yield batch.map(of_text).astype(float)

        return score_texts(F.coalesce(text, F.lit("")).cast("binary"))

    def severity(self, score: Column) -> Column:
        return sum((1 / (1 + F.exp(F.lit(t) - score)) for t in self.thresholds), F.lit(0.0))

    def grade(self, score: Column) -> Column:
        """How many thresholds the text has more likely than not passed."""
        return sum(((score >= t).cast("int") for t in self.thresholds), F.lit(0))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    toxic_col: str = "toxic",
    sample: int = SAMPLE,
) -> Model:
    ready_for_python(docs.sparkSession)
    known = labels.where(F.col(id_col).isNotNull() & F.col(toxic_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(toxic_col).cast("int")).alias("toxic"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(sample)
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")
    # ``sample`` rows of two numbers.
    texts = docs.select(F.col(id_col).alias("id"), text).join(F.broadcast(known), "id")
    # One text per id, however many rows repeat it, so that no more than ``sample`` rows are fitted.
    one = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    texts = stage(texts.groupBy("id").agg(F.max("toxic").alias("toxic"), one).select("toxic", "text"), "labelled")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for toxic, raw in zip(batch["toxic"], batch["text"], strict=True):
                counts[toxic > 0].update(features(raw).keys())
            counts[0].update([b""] * int((batch["toxic"] <= 0).sum()))  # the texts themselves
            counts[1].update([b""] * int((batch["toxic"] > 0).sum()))
            if len(counts[0]) + len(counts[1]) > 60_000:
                yield _table(counts)
                counts = (Counter(), Counter())
        yield _table(counts)

    seen = texts.mapInPandas(count, "feature binary, clean long, toxic long").groupBy("feature")
    seen = seen.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    totals = seen.where("length(feature) = 0").first()
    if not totals or not totals["clean"] or not totals["toxic"]:
        return Model({}, (np.inf, np.inf, np.inf))
    n_clean, n_toxic = totals["clean"], totals["toxic"]
    in_toxic, in_clean = F.col("toxic") / n_toxic, F.col("clean") / n_clean
    share = (F.col("toxic") + F.col("clean")) / (n_toxic + n_clean)
    z = (in_toxic - in_clean) / F.nullif(F.sqrt(share * (1 - share) * (1 / n_toxic + 1 / n_clean)), F.lit(0.0))
    odds = in_toxic / (in_clean + 1 / n_clean)
    telling = seen.where(F.col("toxic") + F.col("clean") >= LEAST_TEXTS).where("length(feature) > 0").where(z >= LEAST_Z)
    chosen = telling.select("feature", (odds >= MARKED_ODDS).alias("marked")).orderBy("feature").collect()
    place = {bytes(r["feature"]): i for i, r in enumerate(chosen)}
    marked = np.array([r["marked"] for r in chosen], dtype=bool)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for toxic, raw in zip(batch["toxic"], batch["text"], strict=True):
                found = sorted((place[f], n) for f, n in features(raw).items() if f in place)
                out.append((int(toxic > 0), [p for p, _ in found], [float(n) for _, n in found]))
            yield pd.DataFrame(out, columns=["toxic", "places", "counts"])

    data = texts.mapInPandas(rows, "toxic int, places array<int>, counts array<double>").toPandas()
    # Equal rows count as one with a weight. Sorted: the order in which tasks deliver rows must not move the weights' last digits.
    kinds = Counter((t, tuple(p), tuple(c)) for t, p, c in zip(data["toxic"], data["places"], data["counts"], strict=True))
    ordered = sorted(kinds)
    toxic, often = np.array([k[0] for k in ordered]), np.array([kinds[k] for k in ordered])
    row = np.repeat(np.arange(len(ordered)), [len(k[1]) for k in ordered])
    col = np.array([p for k in ordered for p in k[1]], dtype=int)
    times = np.minimum(np.array([c for k in ordered for c in k[2]], dtype=float), MOST)
    amount = np.bincount(row, times * marked[col], len(ordered))
    thirds = np.quantile(np.repeat(amount, often * (toxic > 0)), (1 / 3, 2 / 3))
    grades = toxic * (1 + (amount > thirds[0]).astype(int) + (amount > thirds[1]).astype(int))
    weights, thresholds = fit_ordinal(row, col, times, grades, len(place), often)
    return Model({f: float(weights[i]) for f, i in place.items() if weights[i]}, thresholds)


def _table(counts: tuple[Counter, Counter]) -> pd.DataFrame:
    keys = list(counts[0] | counts[1])
    return pd.DataFrame({"feature": keys, "clean": [counts[0][k] for k in keys], "toxic": [counts[1][k] for k in keys]})


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit_ordinal(
    row: np.ndarray,
    col: np.ndarray,
    value: np.ndarray,
    grades: np.ndarray,
    width: int,
    often: np.ndarray | None = None,
    penalty: float = PENALTY,
    rounds: int = ROUNDS,
) -> tuple[np.ndarray, tuple[float, float, float]]:
    """Weights and ordered thresholds of a sparse matrix, by accelerated gradient steps with an L1 penalty.

    ``often`` says how many times each row counts. The order of the thresholds is kept by projection."""
    count = len(grades)
    share = (np.ones(count) if often is None else often) / (count if often is None else often.sum())
    above = np.array([share[grades > k].sum() for k in range(3)]).clip(1e-4, 1 - 1e-4)
    start = np.log(1 / above - 1)
    thetas = np.maximum.accumulate(start)
    weights = np.zeros(width)
    step = 2 / max(1.0, np.quantile(np.bincount(row, value**2, count), 0.99))
    ahead, ahead_t, momentum = weights, thetas, 1.0
    for _ in range(rounds):
        score = np.bincount(row, value * ahead[col], count)
        upper = np.concatenate([ahead_t, [np.inf]])[grades]
        lower = np.concatenate([[-np.inf], ahead_t])[grades]
        a = np.where(grades > 0, _sigmoid(score - np.where(grades > 0, lower, 0)), 1.0)
        b = np.where(grades < 3, _sigmoid(score - np.where(grades < 3, upper, 0)), 0.0)
        likely = np.maximum(a - b, 1e-9)
        slope = (a + b - 1) * share  # of the loss by the score
        of_lower, of_upper = a * (1 - a) / likely * share, -b * (1 - b) / likely * share
        moved = ahead - step * np.bincount(col, value * slope[row], width)
        moved = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        by_theta = np.array([of_lower[grades == k + 1].sum() + of_upper[grades == k].sum() for k in range(3)])
        moved_t = np.maximum.accumulate(ahead_t - step * np.clip(by_theta, -1, 1))
        after = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        ahead = moved + (momentum - 1) / after * (moved - weights)
        ahead_t = np.maximum.accumulate(moved_t + (momentum - 1) / after * (moved_t - thetas))
        weights, thetas, momentum = moved, moved_t, after
    return weights, tuple(float(t) for t in thetas)


def severities(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document row: id, severity (0 to 3), grade, toxic."""
    ready_for_python(docs.sparkSession)
    scored = docs.select(F.col(id_col), model.score(F.col(text_col)).alias("__score"))
    score = F.col("__score")
    return scored.select(
        id_col, model.severity(score).alias("severity"), model.grade(score).alias("grade"), (model.grade(score) > 0).alias("toxic")
    )


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model doesn't reject, with their columns."""
    ready_for_python(docs.sparkSession)
    return docs.where(model.score(F.col(text_col)) < model.thresholds[0])
