"""The trie of all conversation prefixes, as a node table that minimal perfect hashing makes flat.

A node is a distinct sequence of first turns; the root has none. The digest of a prefix is the exclusive or
of strong hashes of its turns, each hashed with its place. So a long conversation is digested in stretches
that are put together afterwards, and a node's parent is its digest without the last turn.

1. Distinct digests are enumerated with the smallest conversation (the owner) and the number of members. A
   third hash that differs within a node stops the run.
2. The nodes of an owner are the end of its path. A shard holds the nodes of some owners in a range of
   depths, and the nodes above them on the same paths. In a shard a minimal perfect hash gives every digest
   a slot, which is verified against the digest stored there.
3. Leaves and savings are scattered into flat arrays by slot and added up through parent slots, deepest
   level first. What lies in deeper ranges of the same path comes in as one number.
4. Sums of a node from several shards are added; they combine before their shuffle.

Rows without a conversation take no part. A missing role or text is empty. Turns are ordered by number, no
number first, then by role and text; rows that repeat a turn are turns of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import mix, ready_for_python
from tidemark.sources.shared import stage

STRETCH, RANGE, SHARD = 256, 4096, 200_000
_KEY = ["k1", "k2"]


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, role, text): turns counted from 1 in their order.

    Rows are sorted over all tasks and counted there, so that no task needs all rows of a conversation.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    turns = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long"), "turn", text("role"), text("text"))
    turns = turns.repartitionByRange("conv_id", "turn", F.substring("role", 1, 32))
    turns = turns.sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    turns = turns.select("conv_id", "role", "text", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    turns = stage(turns, "turns")
    parts = turns.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("conv_id", "part", (F.col("first") - F.coalesce(F.sum("n").over(before), F.lit(0))).alias("zero"))
    depth = F.col("at") - F.col("zero") + 1
    return turns.join(parts, ["conv_id", "part"]).select("conv_id", depth.alias("depth"), "role", "text")


def rebuilt(turns: DataFrame, every: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin as another one: (turns, (conv_id, n_turns) of all, those without turns too).

    With h = crc32(decimal conv_id) % ``most``, conversation c gets the first h turns of conversation
    c - c % ``every`` (all if fewer, none if there is none) in place of its own first h turns.
    """
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h")
    convs = sizes.select("conv_id", "n", head, (F.col("conv_id") - F.col("conv_id") % every).alias("base"))
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    taken = F.least("h", F.coalesce("n_base", F.lit(0))).alias("taken")
    convs = convs.join(bases, "base", "left").select("conv_id", "base", "n", "h", taken)
    convs = stage(convs, "conversations")
    own = turns.join(convs, "conv_id").where("depth > h").select("conv_id", (F.col("depth") - F.col("h") + F.col("taken")).alias("depth"), "role", "text")
    starts = turns.where(F.col("depth") < most).withColumnRenamed("conv_id", "base")
    given = starts.join(convs, "base").where("depth <= taken").select("conv_id", "depth", "role", "text")
    size = (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns")
    return own.unionByName(given), convs.select("conv_id", size)


def _turn_hashes() -> list[Column]:
    """Three numbers of 60 bits from one digest of place, role and text."""
    head = F.concat_ws(":", F.col("depth").cast("string"), F.octet_length("role").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(head, F.col("role"), F.col("text")).cast("binary"), 256)
    return [F.conv(F.substring(digest, 15 * i + 1, 15), 16, 10).cast("long") for i in range(3)]


def _paths(turns: DataFrame, sizes: DataFrame, stretch: int) -> DataFrame:
    """(conv_id, depth, k1, k2, k3, p1, p2, bytes, last): digests of every prefix and of the one before it; root rows too."""
    turns = turns.join(sizes, "conv_id").select(
        "conv_id",
        "depth",
        F.octet_length("text").cast("long").alias("bytes"),
        (F.col("depth") == F.col("n_turns")).alias("last"),
        F.expr(f"(depth - 1) div {stretch}").alias("stretch"),
        *(h.alias(f"t{i}") for i, h in enumerate(_turn_hashes(), 1)),
    )
    turns = stage(turns, "turn-hashes")
    running = W.partitionBy("conv_id", "stretch").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    earlier = W.partitionBy("conv_id").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    long = turns.where("stretch > 0").select("conv_id").distinct()
    sums = turns.join(long, "conv_id", "left_semi").groupBy("conv_id", "stretch").agg(*(F.bit_xor(f"t{i}").alias(f"s{i}") for i in (1, 2, 3)))
    sums = sums.select("conv_id", "stretch", *(F.bit_xor(f"s{i}").over(earlier).alias(f"e{i}") for i in (1, 2, 3)))
    digests = turns.select("*", *(F.bit_xor(f"t{i}").over(running).alias(f"r{i}") for i in (1, 2, 3)))
    digests = digests.join(sums.where("stretch > 0"), ["conv_id", "stretch"], "left")
    for i in (1, 2, 3):
        key = F.col(f"r{i}").bitwiseXOR(F.coalesce(f"e{i}", F.lit(0)))
        digests = digests.withColumn(f"k{i}", key).withColumn(f"p{i}", key.bitwiseXOR(F.col(f"t{i}")))
    names = ["conv_id", "depth", "k1", "k2", "k3", "p1", "p2", "bytes", "last"]
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = sizes.select("conv_id", zero, zero, zero, zero, none, none, zero, F.col("n_turns") == 0).toDF(*names)
    return digests.select(*names).unionByName(root)


class PerfectHash:
    """A minimal perfect hash of distinct keys: slots 0 to n - 1, one each.

    Keys that are alone at their place of a level stay there; the rest goes to the next level. The keys are
    kept by slot, so that a key that is not in the table is told from one that is.
    """

    def __init__(self, k1: np.ndarray, k2: np.ndarray):
        self.levels, self.k1, self.k2 = [], np.empty_like(k1), np.empty_like(k2)
        used = 0
        left = np.arange(len(k1))
        while len(left):
            place = self._place(k1[left], k2[left], len(self.levels), size := max(8, 2 * len(left)))
            alone = np.bincount(place, minlength=size) == 1
            self.levels.append((alone, np.cumsum(alone) - 1 + used))
            used += int(alone.sum())
            left = left[~alone[place]]
            if len(self.levels) > 100:
                raise ValueError("keys repeat")
        slot = self._slot(k1, k2)
        self.k1[slot], self.k2[slot] = k1, k2
        if not (np.bincount(slot, minlength=len(k1)) == 1).all():
            raise ValueError("two keys share a slot")

    @staticmethod
    def _place(k1: np.ndarray, k2: np.ndarray, level: int, size: int) -> np.ndarray:
        mixed = mix(mix(k1.view(np.uint64) + np.uint64(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) ^ k2.view(np.uint64))
        return (mixed % np.uint64(size)).astype(np.int64)

    def _slot(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        slot = np.full(len(k1), -1, dtype=np.int64)
        left = np.arange(len(k1))
        for level, (alone, rank) in enumerate(self.levels):
            place = self._place(k1[left], k2[left], level, len(alone))
            found = alone[place]
            slot[left[found]] = rank[place[found]]
            left = left[~found]
        return slot

    def find(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        """The slots of keys, -1 for those that are not in the table."""
        slot = self._slot(k1, k2)
        known = slot >= 0
        known[known] = (self.k1[slot[known]] == k1[known]) & (self.k2[slot[known]] == k2[known])
        return np.where(known, slot, -1)


def added_up(k1, k2, p1, p2, depth, *values) -> tuple[np.ndarray, ...]:
    """Distinct (k1, k2) and each value summed over the node and all nodes below it that are given."""
    order = np.lexsort((k2, k1))
    new = np.append(True, (k1[order][1:] != k1[order][:-1]) | (k2[order][1:] != k2[order][:-1]))
    one = order[new]
    table = PerfectHash(k1[one], k2[one])
    slot, own = table.find(k1, k2), table.find(k1[one], k2[one])
    parent, level = np.full(len(one), -1, dtype=np.int64), np.zeros(len(one), dtype=np.int64)
    parent[own], level[own] = table.find(p1[one], p2[one]), depth[one]
    parent[level == 0] = -1
    sums = [np.zeros(len(one), dtype=np.int64) for _ in values]
    for total, value in zip(sums, values, strict=True):
        np.add.at(total, slot, value)
    by_level = np.argsort(-level, kind="stable")
    for slots in np.split(by_level, np.flatnonzero(np.diff(level[by_level])) + 1):
        slots = slots[parent[slots] >= 0]
        for total in sums:
            np.add.at(total, parent[slots], total[slots])
    return table.k1, table.k2, *sums


def _shard_sums(group: pd.DataFrame) -> pd.DataFrame:
    columns = [group[c].to_numpy(dtype=np.int64) for c in ("k1", "k2", "p1", "p2", "depth", "leaves", "saved")]
    return pd.DataFrame(dict(zip(["k1", "k2", "leaves", "saved"], added_up(*columns), strict=True)))


def _subtree_sums(paths: DataFrame, nodes: DataFrame, shard: int, range_: int) -> DataFrame:
    """(k1, k2, n_leaves, saved_tokens) of every node."""
    owners = nodes.groupBy(F.col("owner").alias("conv_id")).agg(F.min("depth").alias("top"), F.count("*").alias("n"))
    above = paths.join(owners, "conv_id").where("depth < top")
    zero = F.lit(0).cast("long")
    leaf = (F.col("n_children") == 0).cast("long")
    columns = ["conv_id", "depth", "k1", "k2", "p1", "p2", "leaves", "saved"]
    known = nodes.select(F.col("owner").alias("conv_id"), "depth", *columns[2:6], leaf.alias("leaves"), F.col("own").alias("saved"))
    rows = known.unionByName(above.select(*columns[:6], zero.alias("leaves"), zero.alias("saved")))

    # What an owner has in deeper ranges, at the last node of its path in each range above.
    in_range = F.expr(f"depth div {range_}")
    long = known.where(F.col("depth") >= range_).select("conv_id").distinct()
    sums = known.join(long, "conv_id", "left_semi").groupBy("conv_id", in_range.alias("range")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    steps = sums.groupBy("conv_id").agg(F.max("range").alias("most")).select("conv_id", F.explode(F.sequence(zero, "most")).alias("range"))
    deeper = W.partitionBy("conv_id").orderBy(F.desc("range")).rowsBetween(W.unboundedPreceding, -1)
    carried = steps.join(sums, ["conv_id", "range"], "left").select(
        "conv_id", ((F.col("range") + 1) * range_ - 1).alias("depth"), *(F.sum(c).over(deeper).alias(c) for c in ("leaves", "saved"))
    )
    ends = paths.where(F.col("depth") % range_ == range_ - 1)
    carried = ends.join(carried.where("leaves is not null"), ["conv_id", "depth"]).select(*columns)

    shards = max(1, -(-paths.count() // shard))
    rows = rows.unionByName(carried).withColumn("shard", F.pmod(F.xxhash64("conv_id"), F.lit(shards))).withColumn("range", in_range)
    none = F.lit(0).cast("long")
    rows = rows.withColumn("p1", F.coalesce("p1", none)).withColumn("p2", F.coalesce("p2", none))
    partial = rows.groupBy("shard", "range").applyInPandas(_shard_sums, "k1 long, k2 long, leaves long, saved long")
    return partial.groupBy(*_KEY).agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))


def _end_digests(paths: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256): the digest of the sorted ids of conversations that end at a node.

    Ids are joined within ranges of ids; a node's ranges are then hashed one after the other, none held."""
    ends = paths.where("last").select("conv_id", *_KEY).repartitionByRange("conv_id").withColumn("part", F.spark_partition_id())
    ids = F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",")
    chunks = ends.groupBy(*_KEY, "part").agg(ids.alias("ids"))
    chunks = chunks.repartition(*_KEY).sortWithinPartitions(*_KEY, "part")

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, running = None, None
        for batch in batches:
            done = []
            for k1, k2, ids in zip(batch["k1"].tolist(), batch["k2"].tolist(), batch["ids"], strict=True):
                if (k1, k2) == key:
                    running.update(b"," + ids.encode())
                    continue
                if key is not None:
                    done.append((*key, running.hexdigest()))
                key, running = (k1, k2), hashlib.sha256(ids.encode())
            yield pd.DataFrame(done, columns=["k1", "k2", "ends_sha256"])
        if key is not None:
            yield pd.DataFrame([(*key, running.hexdigest())], columns=["k1", "k2", "ends_sha256"])

    return chunks.mapInPandas(digest, "k1 long, k2 long, ends_sha256 string")


def prefix_trie(
    turns: DataFrame, sizes: DataFrame, stretch: int = STRETCH, range_: int = RANGE, shard: int = SHARD
) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv_id, depth, role, text; depths from 1 without gaps).

    ``sizes`` (conv_id, n_turns) names all conversations, those without turns too. Columns: ``node`` and
    ``parent`` (32 hexadecimal digits), ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``. No conversations give no rows. The other
    parameters change cost only.
    """
    ready_for_python(turns.sparkSession)
    paths = stage(_paths(turns, sizes, stretch), "paths")
    members = paths.groupBy(*_KEY).agg(
        F.min("conv_id").alias("owner"),
        F.count("*").alias("n_convs"),
        *(F.min(c).alias(c) for c in ("depth", "p1", "p2", "bytes")),
        (F.min("k3") != F.max("k3")).alias("clash"),
        (F.min("depth") != F.max("depth")).alias("uneven"),
    )
    clash = F.when(F.col("clash") | F.col("uneven"), F.raise_error(F.lit("two prefixes share a digest")).cast("long"))
    own = F.coalesce(clash, (F.col("n_convs") - 1) * F.col("bytes"))
    members = stage(members.select(*_KEY, "owner", "n_convs", "depth", "p1", "p2", own.alias("own")), "members")
    children = members.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    nodes = members.join(children, _KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = stage(nodes, "nodes")

    sums = _subtree_sums(paths, nodes, shard, range_)
    # Only the topmost node of an owner has a parent of another owner.
    tops = nodes.groupBy("owner").agg(F.min("depth").alias("top")).withColumnRenamed("owner", "of")
    first = nodes.join(tops, (F.col("owner") == F.col("of")) & (F.col("depth") == F.col("top"))).where("depth > 0")
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("owner").alias("parent_owner"))
    above = first.select(*_KEY, "p1", "p2").join(parents, ["p1", "p2"]).select(*_KEY, "parent_owner")
    joined = nodes.join(sums, _KEY).join(_end_digests(paths), _KEY, "left").join(above, _KEY, "left")
    digits = lambda a, b: F.lower(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))
    return joined.select(
        digits("k1", "k2").alias("node"),
        digits("p1", "p2").alias("parent"),
        F.col("owner").alias("conv_id"),
        "depth",
        F.when(F.col("depth") > 0, F.coalesce("parent_owner", "owner")).alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
