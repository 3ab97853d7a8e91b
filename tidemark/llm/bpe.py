"""Byte-level BPE by a rank file: encoding of whole texts in overlapping chunks, and decoding.

A text of up to ``chunk`` characters is encoded where it lies. A longer one is cut into chunks that
overlap by ``overlap`` characters on either side; the chunks are spread over tasks and split into
pre-tokens there. Where two neighbours agree on a pre-token boundary inside their overlap they have
resynchronised, and that boundary is the seam: both derive the same one from the same two lists. Each
chunk then encodes its own piece between two seams, and the ids are put together in chunk order. A
text with an overlap in which no boundaries agree (one pre-token longer than the overlap) is encoded
in one piece, so ids never depend on the chunking.

Null text counts as empty and gives no ids. Repeated rows and null ids of rows are kept as they are.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import ready_for_python

CHUNK, OVERLAP = 1 << 16, 1 << 10


@lru_cache(4)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(4)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})


@lru_cache(4)
def token_bytes(path: str) -> list[bytes]:
    ranks = read_ranks(path)
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


@lru_cache(4)
def _pieces(pattern: str):
    return regex.compile(pattern)


def boundaries(text: str, first: int, low: int, high: int, pattern: str) -> list[int]:
    """Starts of pre-tokens in [low, high), for a chunk that begins at character ``first``.

    The end of the chunk is none: the last pre-token may go on beyond it."""
    starts = (first + m.start() for m in _pieces(pattern).finditer(text))
    return [s for s in starts if low <= s < high]


def _encoder(path: str, pattern: str, with_bytes: bool):
    """Ids where there are none yet, and the bytes they decode to. Null ids and text give nulls.

    One function for both, so that a task needs one Python process."""

    @F.pandas_udf("ids array<int>, bytes binary")
    def encode_texts(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        encode = encoding(path, pattern).encode_ordinary
        for given, texts in batches:
            ids = [
                i if i is not None else None if t is None else np.array(encode(t), dtype=np.int32)
                for i, t in zip(given, texts, strict=True)
            ]
            back = [decoded(i, path) if with_bytes and i is not None else None for i in ids]
            yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "bytes": pd.Series(back, dtype=object)})

    return encode_texts


def decoded(ids: np.ndarray, path: str) -> bytes:
    """The bytes of all tokens, one after the other."""
    return b"".join(map(token_bytes(path).__getitem__, np.asarray(ids, dtype=np.int64).tolist()))


def _seam_lists(pattern: str):
    @F.pandas_udf("head array<long>, tail array<long>")
    def seam_lists(texts: pd.Series, first: pd.Series, core: pd.Series, end: pd.Series, overlap: pd.Series) -> pd.DataFrame:
        rows = [
            (boundaries(t, f, c, c + v, pattern), boundaries(t, f, e, e + v, pattern))
            for t, f, c, e, v in zip(texts, first, core, end, overlap, strict=True)
        ]
        return pd.DataFrame(rows, columns=["head", "tail"])

    return seam_lists


def encode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
    with_bytes: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: the id column and ``ids``, the token ids of the whole text in order.

    ``path`` is a rank file that every executor has; no special tokens are used. ``with_bytes`` adds what
    the ids decode to.
    """
    ready_for_python(docs.sparkSession)
    path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    no_ids = F.lit(None).cast("array<int>")
    encoder = _encoder(path, pattern, with_bytes)
    to_ids = lambda text: _encoder(path, pattern, False)(no_ids, text)["ids"]
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    short = texts.where(F.length("text") <= chunk).select("id", encoder(no_ids, "text").alias("done"))

    long = texts.where(F.length("text") > chunk).select("id", "text", F.monotonically_increasing_id().alias("row"))
    number = F.explode(F.sequence(F.lit(0), F.expr(f"cast((length(text) - 1) div {chunk} as int)")))
    chunks = long.select("id", "row", "text", F.length("text").alias("size"), number.alias("k")).select(
        "id",
        "row",
        "k",
        "size",
        (F.col("k") * chunk).cast("long").alias("core"),
        F.greatest(F.col("k") * chunk - overlap, F.lit(0)).cast("long").alias("first"),
        F.least((F.col("k") + 1) * chunk, F.col("size")).cast("long").alias("end"),
        "text",
    )
    chunks = chunks.withColumn(
        "text", F.substring("text", F.col("first").cast("int") + 1, (F.col("end") - F.col("first") + overlap).cast("int"))
    )
    chunks = chunks.repartition("row", "k")  # the chunks of one long text go to many tasks
    lists = _seam_lists(pattern)("text", "first", "core", "end", F.lit(overlap))
    in_text = W.partitionBy("row").orderBy("k")
    seams = (
        chunks.withColumn("seam", lists)
        .withColumn("start", F.array_min(F.array_intersect(F.lag("seam.tail").over(in_text), F.col("seam.head"))))
        .withColumn("stop", F.array_min(F.array_intersect(F.col("seam.tail"), F.lead("seam.head").over(in_text))))
        .withColumn("start", F.when(F.col("k") == 0, F.lit(0).cast("long")).otherwise(F.col("start")))
        .withColumn("stop", F.when(F.col("end") == F.col("size"), F.col("size").cast("long")).otherwise(F.col("stop")))
    )
    fits = F.coalesce(F.col("start") <= F.col("stop"), F.lit(False))
    cut = F.substring("text", (F.col("start") - F.col("first")).cast("int") + 1, (F.col("stop") - F.col("start")).cast("int"))
    own = F.substring("text", (F.col("core") - F.col("first")).cast("int") + 1, (F.col("end") - F.col("core")).cast("int"))
    pieces = seams.withColumn("met", F.min(fits).over(W.partitionBy("row"))).select(
        "id", "row", "k", F.when(F.col("met"), to_ids(F.when(F.col("met"), cut))).alias("ids"), F.when(~F.col("met"), own).alias("own")
    )
    # A document's own ids, which its result row holds anyway.
    ordered = F.array_sort(F.collect_list(F.struct("k", "ids", "own")))
    whole = pieces.groupBy("row").agg(F.first("id").alias("id"), ordered.alias("parts"))
    unmet = F.element_at("parts", 1)["own"].isNotNull()
    stitched = F.when(~unmet, F.flatten(F.col("parts.ids")))
    at_once = F.when(unmet, F.array_join(F.col("parts.own"), ""))
    result = short.unionByName(whole.select("id", encoder(stitched, at_once).alias("done")))
    return result.select(F.col("id").alias(id_col), "done.ids", *(["done.bytes"] if with_bytes else []))


def decode(encoded: DataFrame, ids_col: str = "ids", out_col: str = "bytes", path: str | None = None) -> DataFrame:
    """``encoded`` with the bytes of its ids in a further column. Null ids give null."""
    ready_for_python(encoded.sparkSession)
    path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

    @F.pandas_udf("binary")
    def to_bytes(ids: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in ids:
            yield pd.Series([None if i is None else decoded(i, path) for i in batch], dtype=object)

    return encoded.withColumn(out_col, to_bytes(ids_col))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row: how many ids, the SHA-256 of the ids and that of the bytes they decode to."""
    back = encode(docs, id_col, text_col, with_bytes=True, **options)
    return back.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
