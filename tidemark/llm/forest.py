"""Approximate nearest neighbours by a hash-prefix forest.

The vectors are dealt at random to shards of about ``shard`` rows, each of which carries a forest of its
own. A tree hashes every vector of the shard to a string of ``BITS`` signs of random projections, and keeps
the strings as one sorted array. A query descends in every tree to the strings that share its longest
prefix, a run of the array found by binary search. It then ascends in all trees at once, one bit at a
time, until the runs of all trees together hold at least ``share`` times as many entries as the shard has
vectors. All vectors in these runs are candidates, however many share a prefix, and are ranked by their
exact distance. The best of each shard are merged. As every shard has the same number of vectors, whatever
their total, recall does not fall as the table grows; with the default values it is about 0.97 on vectors
without any structure.

Queries go to shards in blocks, each shard and block being one task: neither vectors nor queries are
collected. Equal vectors are spread over the shards by their id.

Rows with a null id, or a vector that is null, empty, zero or holds a null or a number that isn't finite,
take no part, neither as queries nor as candidates. Only vectors of one length are compared. Repeated rows
count once; a candidate with the query's id is the query itself. Ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import ready_for_python
from tidemark.sources.shared import stage

TREES, BITS, SHARD, SHARE, QUERIES = 96, 48, 16_384, 0.45, 4096
_AT_ONCE = 256
_FOUND = "query_id bigint, query_key bigint, vec_id bigint, score double"


class Forest:
    """The trees over some vectors."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = 7):
        self.vectors, self.trees, self.bits = vectors, trees, bits
        self.centre = vectors.mean(axis=0)
        self.planes = np.random.default_rng(seed).standard_normal((trees, vectors.shape[1], bits))
        hashes = self.hash(vectors)
        self.order = np.argsort(hashes, axis=1, kind="stable")
        self.sorted = np.take_along_axis(hashes, self.order, axis=1)

    def hash(self, vectors: np.ndarray) -> np.ndarray:
        """The hash strings, as numbers whose high bits come first: one row per tree."""
        out = np.empty((self.trees, len(vectors)), dtype=np.uint64)
        weights = np.uint64(1) << np.arange(self.bits - 1, -1, -1, dtype=np.uint64)
        moved = vectors - self.centre
        for tree in range(self.trees):
            out[tree] = ((moved @ self.planes[tree] > 0) * weights).sum(axis=1, dtype=np.uint64)
        return out

    def candidates(self, queries: np.ndarray, least: int) -> Iterator[np.ndarray]:
        """Per query the places of the vectors found after ascending to at least ``least`` entries."""
        hashes = self.hash(queries)
        low = np.empty((self.bits + 1, self.trees, len(queries)), dtype=np.int64)
        high = np.empty_like(low)
        for level in range(self.bits + 1):  # bits of the prefix that are dropped
            step = np.uint64(level)
            first = (hashes >> step) << step
            past = first + (np.uint64(1) << step)
            for tree in range(self.trees):
                low[level, tree] = np.searchsorted(self.sorted[tree], first[tree], "left")
                high[level, tree] = np.searchsorted(self.sorted[tree], past[tree], "left")
        enough = (high - low).sum(axis=1) >= least
        level = np.where(enough.any(axis=0), enough.argmax(axis=0), self.bits)
        for q in range(len(queries)):
            found = np.zeros(len(self.vectors), dtype=bool)
            for tree in range(self.trees):
                found[self.order[tree, low[level[q], tree, q] : high[level[q], tree, q]]] = True
            yield np.flatnonzero(found)


def nearest(
    vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int, share: float = SHARE, **options
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per query: its place, the ids of the nearest vectors found and their distances."""
    forest = Forest(vectors, **options)
    # More than k + 1 per tree: some tree then has k vectors besides the query's own, if there are as many.
    least = max((k + 1) * forest.trees + 1, int(share * len(vectors)))
    # A few queries at a time: the places of their prefixes take bits x trees numbers each.
    slices = (forest.candidates(queries[a : a + _AT_ONCE], least) for a in range(0, len(queries), _AT_ONCE))
    for q, places in enumerate(chain.from_iterable(slices)):
        places = places[ids[places] != query_ids[q]]
        gaps = vectors[places] - queries[q]
        far = np.sqrt((gaps * gaps).sum(axis=1))
        best = np.lexsort((ids[places], far))[:k]
        yield q, ids[places][best], far[best]


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def search(
    rows: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard: int = SHARD,
    share: float = SHARE,
    block: int = QUERIES,
) -> DataFrame:
    """Per query row of ``rows``: query_id, rank (from 1), vec_id and score of its ``k`` nearest rows."""
    spark = rows.sparkSession
    ready_for_python(spark)
    vector = F.col(vector_col).cast("array<double>")
    able = rows.select(F.col(id_col).cast("long").alias("id"), vector.alias("v"), is_query.alias("asks"))
    able = able.where("id is not null").where(usable(F.col("v"))).withColumn("v_key", F.xxhash64("v"))
    able = able.groupBy("id", "v_key").agg(F.first("v").alias("v"), F.max("asks").alias("asks"))
    able = stage(able.withColumn("size", F.size("v")), "vectors")
    totals = able.groupBy("size").agg(F.count("*").alias("n"), F.count_if("asks").alias("q"))
    # One row per length of vectors: how many shards and blocks of queries there are.
    shards = F.ceil(F.col("n") / shard).cast("int")
    blocks = F.ceil(F.greatest(F.col("q"), F.lit(1)) / block).cast("int")
    plan = stage(totals.where("q > 0").select("size", shards.alias("shards"), blocks.alias("blocks")), "plan")

    dealt = able.join(plan, "size")
    own_shard = F.pmod(F.xxhash64("id", "v_key"), F.col("shards")).cast("int")
    own_block = F.pmod(F.xxhash64("id", "v_key"), F.col("blocks")).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    indexed = dealt.select("size", own_shard.alias("shard"), all_of(F.col("blocks")).alias("block"), "id", "v")
    new = lambda name: F.col(name).alias(name)  # noqa: E731  both sides come from one frame
    asked = dealt.where("asks").select(
        new("size"), all_of(F.col("shards")).alias("shard"), own_block.alias("block"), new("id"), new("v_key"), new("v")
    )

    def of_group(members: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(members) or not len(queries):
            return pd.DataFrame(columns=["query_id", "query_key", "vec_id", "score"])
        members = members.sort_values(["id"], kind="stable")
        found = nearest(
            np.stack(members["v"].to_list()), members["id"].to_numpy(), np.stack(queries["v"].to_list()), queries["id"].to_numpy(), k, share
        )
        keys = queries["v_key"].to_numpy()
        ids = queries["id"].to_numpy()
        parts = [pd.DataFrame({"query_id": ids[q], "query_key": keys[q], "vec_id": i, "score": s}) for q, i, s in found]
        return pd.concat(parts) if parts else pd.DataFrame(columns=["query_id", "query_key", "vec_id", "score"])

    near = indexed.groupBy("size", "shard", "block").cogroup(asked.groupBy("size", "shard", "block")).applyInPandas(of_group, _FOUND)
    # An id with several vectors counts with its nearest one.
    near = near.groupBy("query_id", "query_key", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id", "query_key").orderBy("score", "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
