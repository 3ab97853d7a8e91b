"""Documents to tokens: toxic texts go, one of each group of near copies stays, leaked ones go, the rest is encoded.

Every stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet to the shared
folder and read again as the next one's ``docs``. All but the last return the columns of documents.
Rows without an id, without text and repeated rows go through every stage; see the operators' docstrings.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, decontaminate, neardup, toxicity
from tidemark.llm.common import table
from tidemark.sources.shared import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document stays unless the model, fitted on the given labels, finds it more likely toxic than not."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8, that with the smallest id stays."""
    return neardup.without_near_duplicates(docs, shingle=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document with a passage of a benchmark item goes."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: number of tokens, and digests of the ids and of what they decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(docs, path=path, pattern=public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

# A fitted model, MinHash and BPE merges have no SQL; tests compare with brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
