"""Phrases that words form more often than chance, mined by partitioning (SON).

A phrase is a run of words inside a piece of text; pieces end at ``. , ; : ! ?`` and line ends, words at
spaces and tabs. Everything is per group (language).

1. Texts are dealt out to shards of one group each, of at most about ``shard`` bytes. A group has ``support / 2``
   shards if these are a megabyte or more, so that the lowered support is 2 for small and large groups alike.
2. Each shard is mined completely, at a support lowered in proportion: a phrase with ``support`` places in all
   has at least ``ceil(support * bytes of the shard / bytes of the group)`` in some shard.
3. The union of what is frequent somewhere is cut by a bound: where a shard did not report a phrase it has
   less than the shard's support.
4. All phrases left are counted in every shard, by their texts, and added up exactly. A bit set of fixed size
   tells which may be wanted.

Words and pairs are done first, then longer phrases, of which only those are looked at whose words and pairs
are frequent. Parts of a frequent phrase are frequent, so the same counts give a phrase's parts. A phrase is
scored by the cut into two parts that scores lowest, ``floor(scale * a / (l + r))`` in whole numbers of 38
digits. A phrase inside a longer one that has nearly as many places goes.

Null text counts as empty, a null group as ``und``, repeated rows count as often as they come. Very long texts
are looked at in slices between pieces; one that is longer than a shard makes a larger shard. Where a group
has more shards than ``support``, the lowered support is 1, and shards only add up what they have.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from tidemark.llm.common import Slots, holds, mix, ready_for_python, slots_of
from tidemark.sources.shared import stage

LONGEST, SUPPORT, SHARD, LEAST = 4, 30, 20 << 20, 1 << 20
_AT_ONCE = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_TURN = np.uint64(0xC4CEB9FE1A85EC53)
# Fixed values of the word rule: white space between words, and what ends a piece.
_BLANKS, _BREAKS = b" \t", b".,;:!?\n\x0b\x0c\r"

_BREAK = re.compile(b"[" + re.escape(_BREAKS) + b"]")
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_KIND = np.array([1 if c in _BLANKS else 2 if c in _BREAKS else 0 for c in range(256)], dtype=np.uint8)
_UP = np.cumprod(np.array([1] + [_BASE] * (2 * _AT_ONCE), dtype=np.uint64))
_DOWN = np.cumprod(np.array([1] + [pow(_BASE, -1, 1 << 64)] * (2 * _AT_ONCE), dtype=np.uint64))


def _pieces_of(raw: bytes) -> Iterator[bytes]:
    """``raw`` in slices of about ``_AT_ONCE`` bytes that end between pieces."""
    at = 0
    while len(raw) - at > _AT_ONCE and (end := _BREAK.search(raw, at + _AT_ONCE)):
        yield raw[at : end.end()]
        at = end.end()
    yield raw[at:]


class Words:
    """The words of many texts: their hashes, in which piece each lies, and their texts joined by spaces.

    The list of texts is emptied, as they are held once more in one piece."""

    def __init__(self, texts: list[bytes], with_text: bool = False):
        hashes, pieces, norms, lengths, piece = [], [], [], [], 0
        texts.append(b"")
        whole = b"\n".join(texts)
        texts.clear()
        whole = whole.translate(_LOWER)
        place = np.int32 if len(whole) < 1 << 31 else np.int64
        for raw in _pieces_of(whole):
            text = np.frombuffer(raw + b"\n", np.uint8)
            kind = _KIND[text]
            inside = kind == 0
            edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
            edge = np.append(0, edge) if inside[0] else edge
            start, end = edge[::2], edge[1::2]
            sums = np.zeros(len(text) + 1, dtype=np.uint64)
            up, down = (_UP, _DOWN) if len(text) < len(_UP) else _powers(len(text))
            np.cumsum(text * up[: len(text)], out=sums[1:])
            hashes.append(mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64)))
            number = np.cumsum(kind == 2)
            pieces.append((number[start] + piece).astype(place))
            piece += int(number[-1]) + 1
            if with_text:
                kept = inside.copy()
                kept[end] = True
                norm = text.copy()
                norm[end] = 0x20
                norms.append(norm[kept])
                lengths.append((end - start + 1).astype(place))
        self.hash, piece = np.concatenate(hashes), np.concatenate(pieces)
        del hashes, pieces, whole
        # How many words of the piece are left from each word on, LONGEST at most.
        self.left = np.ones(len(piece), dtype=np.uint8)
        for n in range(1, LONGEST):
            self.left[: len(piece) - n][piece[n:] == piece[: len(piece) - n]] = n + 1
        if with_text:
            self.norm = np.concatenate(norms)
            lengths = np.concatenate(lengths)
            self.end = np.cumsum(lengths, dtype=place)
            self.start = self.end - lengths

    def grams(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, hashes by first word, which first words have n words), for n from 1 on."""
        hashes = self.hash
        for n in range(1, longest + 1):
            if n > 1:
                hashes = mix(hashes[:-1] * _TURN + self.hash[n - 1 :])
            yield n, hashes, self.left[: len(hashes)] >= n

    def texts(self, first: np.ndarray, n: int) -> pa.Array:
        begin = self.start[first].astype(np.int64)
        size = self.end[first + n - 1] - 1 - begin
        offsets = np.zeros(len(first) + 1, dtype=np.int32)
        np.cumsum(size, out=offsets[1:])
        place = np.arange(offsets[-1]) + np.repeat(begin - offsets[:-1], size)
        return pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(self.norm[place])])


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, dtype=np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """(group, texts) of each shard that a task reads; a shard's rows lie together."""
    shard, group, held = None, "", []
    for batch in batches:
        for number, own, text in zip(*(batch[c].to_pylist() for c in ("shard", "group", "text")), strict=True):
            if number != shard and held:
                yield group, held
                held = []
            shard, group = number, own
            held.append(text)
    if held:
        yield group, held


def _wanted(hashes: np.ndarray, valid: np.ndarray, packed: np.ndarray | None, group: str) -> np.ndarray:
    """Of the valid ones, those that the bit set may hold."""
    if packed is None:
        return valid
    at = np.flatnonzero(valid)
    out = np.zeros(len(hashes), dtype=bool)
    out[at[holds(packed, slots_of(_keyed(hashes[at], group)))]] = True
    return out


def _local(texts: DataFrame, total: dict[str, int], support: int, sizes: tuple[int, int], known: Slots | None) -> DataFrame:
    """(group, hash, count, lacking): phrases frequent in a shard. ``lacking`` is one less than the shard's support.

    Shorter phrases than those of ``sizes`` are looked up in ``known``. A row per shard without a hash holds
    the number of words."""
    low, high = sizes
    sent = known.sent if known else None

    def mine(words: Words, group: str, lowered: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        before = None
        for n, hashes, valid in words.grams(high):
            if before is not None:
                valid = valid & before[:-1] & before[1:]
            if n < low:
                before = _wanted(hashes, valid, sent.value, group)
                continue
            at = np.flatnonzero(valid)
            order = np.argsort(hashes[at], kind="stable")
            ranked = hashes[at][order]
            first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(at) else at
            count = np.diff(np.append(first, len(at)))
            often = count >= lowered
            yield _keyed(ranked[first[often]], group), count[often]
            before = np.zeros(len(hashes), dtype=bool)
            before[at[order[np.repeat(often, count)]]] = True

    def mine_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, held in _shards(batches):
            lowered = max(1, -(-support * sum(map(len, held)) // max(total[group], 1)))
            words = Words(held)
            yield _batch(group, None, np.array([len(words.hash)]), lowered)
            for hashes, counts in mine(words, group, lowered):
                for a in range(0, len(hashes), 1 << 16):
                    yield _batch(group, hashes[a : a + (1 << 16)], counts[a : a + (1 << 16)], lowered)

    def _batch(group: str, hashes: np.ndarray | None, counts: np.ndarray, lowered: int) -> pa.RecordBatch:
        k = len(counts)
        keys = pa.nulls(k, pa.int64()) if hashes is None else pa.array(hashes.view(np.int64))
        columns = [pa.array([group] * k, pa.string()), keys, pa.array(counts.astype(np.int64)), pa.array(np.full(k, lowered - 1, np.int64))]
        return pa.RecordBatch.from_arrays(columns, ["group", "hash", "count", "lacking"])

    return texts.mapInArrow(mine_shards, "group string, hash long, count long, lacking long")


def _counted(texts: DataFrame, slots: Slots, sizes: tuple[int, int]) -> DataFrame:
    """(group, phrase, n, hash, count): per shard, every phrase of ``sizes`` words that may be wanted, as all its parts may be."""
    sent, (low, high) = slots.sent, sizes

    def count_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, held in _shards(batches):
            words, before = Words(held, with_text=True), None
            for n, hashes, valid in words.grams(high):
                if before is not None:
                    valid = valid & before[:-1] & before[1:]
                before = _wanted(hashes, valid, sent.value, group)
                if n < low:
                    continue
                at = np.flatnonzero(before)
                found, first, counts = np.unique(hashes[at], return_index=True, return_counts=True)
                found = _keyed(found, group)
                for a in range(0, len(found), 1 << 16):
                    b = min(a + (1 << 16), len(found))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([group] * (b - a), pa.string()),
                            words.texts(at[first[a:b]], n),
                            pa.array(np.full(b - a, n, np.int32)),
                            pa.array(found[a:b].view(np.int64)),
                            pa.array(counts[a:b].astype(np.int64)),
                        ],
                        ["group", "phrase", "n", "hash", "count"],
                    )

    return texts.mapInArrow(count_shards, "group string, phrase string, n int, hash long, count long")


def _keyed(hashes: np.ndarray, group: str) -> np.ndarray:
    """Hashes of phrases, told apart by group."""
    return mix(hashes + np.uint64(zlib.crc32(group.encode())))


def _sharded(docs: DataFrame, text_col: str, group_col: str, support: int, shard: int) -> tuple[DataFrame, dict[str, int]]:
    """Texts dealt out to shards of one group each, in the shared folder, and the bytes of each group.

    Groups are languages, and few, so their sizes are collected. Equal texts are spread by the other columns."""
    group = F.coalesce(F.col(group_col).cast("string"), F.lit("und"))
    plain = [f.name for f in docs.schema.fields if isinstance(f.dataType, AtomicType)]
    texts = docs.select(group.alias("group"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"), F.xxhash64(*plain).alias("spread"))
    total = {r["group"]: r["size"] for r in texts.groupBy("group").agg(F.sum(F.octet_length("text")).alias("size")).collect()}
    if not total:
        return stage(texts.select("group", "text", F.lit(0).alias("shard")), "shards"), total
    shards = {g: max(1, -(-size // shard), min(support // 2, size // LEAST)) for g, size in total.items()}
    first = dict(zip(shards, accumulate(shards.values(), initial=0), strict=False))
    per_group = lambda values: F.create_map(*(F.lit(x) for g in values for x in (g, values[g])))[F.col("group")]
    number = (per_group(first) + F.pmod("spread", per_group(shards))).cast("int")
    dealt = texts.select("group", "text", number.alias("shard")).repartitionById(sum(shards.values()), "shard")
    return stage(dealt, "shards"), total


def _level(
    texts: DataFrame, total: dict[str, int], support: int, sizes: tuple[int, int], shorter: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(exact counts of phrases of ``sizes`` words with ``support`` places, words of each group)."""
    known = Slots(shorter, "hash") if shorter is not None else None
    local = stage(_local(texts, total, support, sizes, known), "phrases-local")
    groups = local.where("hash is null").groupBy("group").agg(F.sum("count").alias("n"), F.sum("lacking").alias("most"))
    reported = local.where("hash is not null").groupBy("group", "hash").agg(F.sum("count").alias("count"), F.sum("lacking").alias("own"))
    bound = F.col("count") + F.col("most") - F.col("own")
    union = reported.join(groups, "group").where(bound >= support).select("hash")
    union = stage(union if shorter is None else union.unionByName(shorter.select("hash")), "phrases-union")
    counted = _counted(texts, Slots(union, "hash"), sizes).groupBy("group", "phrase")
    exact = counted.agg(F.first("n").alias("n_words"), F.first("hash").alias("hash"), F.sum("count").alias("a"))
    return stage(exact.where(F.col("a") >= support), "phrases"), groups.select("group", "n")


def frequent(
    docs: DataFrame,
    text_col: str = "text",
    group_col: str = "lang",
    longest: int = LONGEST,
    support: int = SUPPORT,
    shard: int = SHARD,
) -> DataFrame:
    """(group, phrase, n_words, a, n): phrases of up to ``longest`` (at most 4) words with ``support`` places, and the group's words."""
    ready_for_python(docs.sparkSession)
    texts, total = _sharded(docs, text_col, group_col, support, shard)
    found, groups = _level(texts, total, support, (1, min(2, longest)))
    if longest > 2:
        found = found.unionByName(_level(texts, total, support, (3, longest), found)[0])
    return found.drop("hash").join(groups, "group")


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    group_col: str = "lang",
    longest: int = LONGEST,
    support: int = SUPPORT,
    best: int = 2000,
    inside_percent: int = 80,
    scale: int = 2_000_000,
    shard: int = SHARD,
) -> DataFrame:
    """(group column, rank, phrase, a, l, r, n, score): each group's ``best`` phrases of two words or more.

    By score, then places, both falling, then the phrase in byte order.
    """
    known = frequent(docs, text_col, group_col, longest, support, shard)
    words = F.split("phrase", " ")
    joined = lambda start, size: F.array_join(F.slice(words, start, size), " ")

    cuts = known.where("n_words > 1").select("*", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k"))
    cuts = cuts.select("*", joined(F.lit(1), F.col("k")).alias("first"), joined(F.col("k") + 1, F.col("n_words") - F.col("k")).alias("rest"))
    left = known.select("group", F.col("phrase").alias("first"), F.col("a").alias("l"))
    right = known.select("group", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    score = F.expr(f"(cast({scale} as decimal(19, 0)) * cast(a as decimal(18, 0))) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))")
    scored = cuts.join(left, ["group", "first"]).join(right, ["group", "rest"]).withColumn("score", score)
    scored = scored.groupBy("group", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    # Every run of words within a longer phrase, with the most places of a phrase that has it.
    size, start = F.sequence(F.lit(2), F.col("n_words") - 1), F.sequence(F.lit(1), F.col("n_words") - F.col("size") + 1)
    within = known.where("n_words > 2").select("*", F.explode(size).alias("size")).select("*", F.explode(start).alias("start"))
    within = within.select("group", joined(F.col("start"), F.col("size")).alias("phrase"), F.col("a").alias("longer"))
    within = within.groupBy("group", "phrase").agg(F.max("longer").alias("longer"))
    apart = F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(inside_percent) * F.col("a"))
    kept = scored.join(within, ["group", "phrase"], "left").where(apart)

    order = W.partitionBy("group").orderBy(F.desc("cut.score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.select(
        F.col("group").alias(group_col), F.col("rank").cast("long"), "phrase", "a", "cut.l", "cut.r", "n", F.col("cut.score").alias("score")
    )
