from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [
    "", None, "a" * 50, "hello   world\n\n x" * 30, "a" * 3000, " " * 700, "it's 12345 " * 100 + "\n" * 40 + "ééß..." * 50,
    "日本語 " * 200, "x y  \t\n z" * 99, "<|endoftext|>", "\U0001f600 \U0001f469‍\U0001f4bb" * 40,
]
SCHEMA = "doc_id long, text string"


@pytest.mark.parametrize(("chunk", "overlap"), [(64, 16), (100, 20), (64, 3), (1 << 16, 1 << 10)])
def test_ids_do_not_depend_on_chunks(spark, chunk, overlap):
    rows = [(i if i else None, t) for i, t in enumerate(TEXTS * 2)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("ids", F.lit("x")).withColumn("row", F.lit(1))
    encode = bpe.encoding(PATH, public_tokenizers.PATTERN).encode_ordinary
    got = brute.rows(bpe.encode(df, path=PATH, chunk=chunk, overlap=overlap))
    assert got == sorted(((i, encode(t or "")) for i, t in rows), key=str)


def test_round_trip_and_digests(spark):
    rows = list(enumerate(TEXTS))
    got = {r.doc_id: r for r in bpe.digests(spark.createDataFrame(rows, SCHEMA), chunk=64, overlap=16).collect()}
    for i, text in rows:
        ids = bpe.encoding(PATH, public_tokenizers.PATTERN).encode_ordinary(text or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_decoding_ids_of_another_source(spark):
    rows = [(1, [5, 6]), (2, []), (3, None)]
    got = {r.doc_id: r.bytes for r in bpe.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>")).collect()}
    table = bpe.token_bytes(PATH)
    assert got == {1: table[5] + table[6], 2: b"", 3: None}


def test_empty_table(spark):
    assert bpe.digests(spark.createDataFrame([], SCHEMA)).count() == 0
