"""Removal of repeated passages across documents, by suffix arrays of shards.

A string of ``length`` bytes that also starts in a document with a smaller id is removed wherever it lies.
The arrays are built by induced sorting (``suffix``) over shards that hold all places of a string:

1. Documents are packed into blocks once, in a table that Spark keeps bucketed by block, so that no later
   step shuffles texts. Long texts are looked at in pieces.
2. The anchor of a window (``length`` bytes) is the smallest hash of its ``GRAM``-byte grams. Equal windows
   have equal anchors. Anchors are counted by slices of the hash range; one of a single document cannot lie
   in a repeat.
3. Runs of windows with one shared anchor go to the slice of the anchor, equal runs of a block as one.
   There they are joined to one text per shard, separated by a byte that UTF-8 never has; its suffix array is
   induced, and permuted common prefixes of ``length`` or more bytes join equal windows. The smallest document
   of each group says which places go. Anchors that very many documents have are split: their windows travel
   one by one, to the slices of their own hashes.
4. Ranges go back to the blocks, where they are cut out.

Texts are UTF-8 bytes; null is empty. Documents are told apart by id alone, so rows that repeat an id are one
document, which removes nothing from itself. A row without id comes after all others: it loses what a document
with an id has, and nothing is lost to it. Ids are whole numbers.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mix, ready_for_python
from tidemark.llm.suffix import permuted_prefixes, suffix_array
from tidemark.sources.shared import own_path

LENGTH, GRAM = 50, 20
BLOCK, BUCKET, SLICE, SHARD = 4 << 20, 8 << 20, 8 << 20, 1 << 20
HOT = 1 << 13
_RUN, _AT_ONCE, _BITS, _LAST = 64, 1 << 18, np.uint64(48), np.iinfo(np.int64).max
_BASE = 0x9E3779B97F4A7C15

_RUN_DTYPES = ("u1", "u4", "u2", "u4", "u4", "i8", "u1")


def pack(*arrays: np.ndarray) -> bytes:
    sizes = np.array([len(a) for a in arrays], dtype=np.int64)
    return zstandard.compress(b"".join([sizes.tobytes(), *(np.ascontiguousarray(a).tobytes() for a in arrays)]), 1)


def unpack(blob: bytes, *dtypes: str) -> list[np.ndarray]:
    raw = zstandard.decompress(blob)
    at, out = 8 * len(dtypes), []
    for size, dtype in zip(np.frombuffer(raw, np.int64, len(dtypes)), map(np.dtype, dtypes), strict=True):
        out.append(np.frombuffer(raw, dtype, int(size), at))
        at += int(size) * dtype.itemsize
    return out


class Block:
    """Documents of a block; of equal texts only that with the smallest id is looked at."""

    def __init__(self, packed: bytes):
        self.id, size, self.data = unpack(packed, "i8", "i8", "u1")
        self.end = np.cumsum(size)
        self.start = self.end - size
        self.raw, first = self.data.tobytes(), {}
        order = np.argsort(self.id, kind="stable")
        self.same = np.empty(len(size), dtype=np.int64)  # the document looked at in place of each
        for i, a, b in zip(order.tolist(), self.start[order].tolist(), self.end[order].tolist(), strict=True):
            self.same[i] = first.setdefault(self.raw[a:b], i)
        self.looked_at = np.array(list(first.values()), dtype=np.int64)


@lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, dtype=np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _hashes(text: np.ndarray, length: int) -> np.ndarray:
    """Of every substring of that length."""
    up, down = _powers(1 << max(len(text) - 1, 1).bit_length())
    sums = np.zeros(len(text) + 1, dtype=np.uint64)
    np.cumsum(text * up[: len(text)], out=sums[1:])
    return mix((sums[length:] - sums[:-length]) * down[: len(text) - length + 1])


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def runs(block: Block, length: int, gram: int, at_once: int = _AT_ONCE) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, documents, starts in the text, starts in the documents, numbers of windows, anchors), about ``at_once`` bytes at once.

    A run of windows has one anchor, and at most ``_RUN`` windows, so that a periodic text repeats its runs.
    """
    windows = (block.end - block.start)[block.looked_at] - length + 1
    docs, windows = block.looked_at[windows > 0], windows[windows > 0]
    # A long text is looked at in pieces that share no window.
    parts = -(-windows // at_once)
    k = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    docs, size = np.repeat(docs, parts), np.minimum(np.repeat(windows, parts) - k * at_once, at_once) + length - 1
    offset = k * at_once
    for cut in np.split(np.arange(len(docs)), np.flatnonzero(np.diff(np.cumsum(size) // at_once)) + 1):
        if not len(cut):
            continue
        begin = block.start[docs[cut]] + offset[cut]
        text = np.concatenate([block.data[a:b] for a, b in zip(begin.tolist(), (begin + size[cut]).tolist(), strict=True)])
        end = np.cumsum(size[cut])
        # Smallest hashes are small numbers; mixed again they spread evenly over the slices.
        anchors = mix(_smallest(_hashes(text, gram), length - gram + 1)) >> (np.uint64(64) - _BITS)
        owner = np.repeat(np.arange(len(cut)), size[cut])[: len(anchors)]
        valid = np.arange(len(anchors)) + length <= end[owner]
        new = np.ones(len(anchors), dtype=bool)
        new[1:] = (anchors[1:] != anchors[:-1]) | (owner[1:] != owner[:-1]) | (valid[1:] != valid[:-1])
        at = np.flatnonzero(new)
        n = np.diff(np.append(at, len(anchors)))
        at, n = at[valid[at]], n[valid[at]]
        pieces = -(-n // _RUN)
        if pieces.max(initial=1) > 1:
            k = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            at, n = np.repeat(at, pieces) + k * _RUN, np.minimum(np.repeat(n, pieces) - k * _RUN, _RUN)
        own = owner[at]
        yield text, docs[cut[own]], at, at - (end - size[cut])[own] + offset[cut[own]], n, anchors[at]


def _slice_of(hashes: np.ndarray, n: int) -> np.ndarray:
    return ((hashes * np.uint64(n)) >> _BITS).astype(np.int64)


def _packed(texts: DataFrame, block: int) -> DataFrame:
    """Rows of (block, packed): what one task reads of ``texts`` (id, bytes), cut where it exceeds ``block`` bytes."""

    def pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, kept, size = TaskContext.get().partitionId() << 32, [], [], 0

        def out() -> pa.RecordBatch:
            sizes = np.array([len(t) for t in kept], dtype=np.int64)
            blob = pack(np.array(ids, dtype=np.int64), sizes, np.frombuffer(b"".join(kept), np.uint8))
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([blob])], ["block", "packed"])

        for batch in batches:
            ids += batch["id"].fill_null(_LAST).to_pylist()
            kept += batch["bytes"].to_pylist()
            size += batch.nbytes
            if size > block:
                yield out()
                number, ids, kept, size = number + 1, [], [], 0
        if kept:
            yield out()

    return texts.mapInArrow(pack_rows, "block long, packed binary")


def _bucketed(blocks: DataFrame, buckets: int) -> DataFrame:
    name = f"blocks_{uuid.uuid4().hex}"
    path = own_path(blocks.sparkSession, "blocks")
    blocks.write.bucketBy(buckets, "block").option("path", path).saveAsTable(name)
    return blocks.sparkSession.table(name)


def _anchor_counts(blocks: DataFrame, slices: int, length: int, gram: int) -> DataFrame:
    """(block, slice, blob): the block's anchors in order, and in how many of its documents each lies, 255 at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, packed in zip(batch["block"].to_pylist(), batch["packed"].to_pylist(), strict=True):
                block = Block(packed)
                found = [(anchor, block.id[doc]) for _, doc, _, _, _, anchor in runs(block, length, gram)]
                if not found:
                    continue
                anchor, ids = map(np.concatenate, zip(*found, strict=True))
                order = np.argsort(anchor, kind="stable")  # ids of an anchor stay in order
                anchor, ids = anchor[order], ids[order]
                first = np.append(True, anchor[1:] != anchor[:-1])
                other = first | np.append(True, ids[1:] != ids[:-1])
                docs = np.add.reduceat(other.astype(np.int64), np.flatnonzero(first))
                anchor, docs = anchor[first], np.minimum(docs, 255).astype(np.uint8)
                of_slice = _slice_of(anchor, slices)
                cuts = np.append(np.flatnonzero(np.append(True, of_slice[1:] != of_slice[:-1])), len(anchor))
                blobs = [pack(np.diff(anchor[a:b], prepend=np.uint64(0)), docs[a:b]) for a, b in zip(cuts, cuts[1:])]  # noqa: B905
                n = len(blobs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * n), pa.array(of_slice[cuts[:-1]]), pa.array(blobs, pa.binary())],
                    ["block", "slice", "blob"],
                )

    return blocks.mapInArrow(count, "block long, slice long, blob binary")


def _shared_anchors(counts: DataFrame, hot: int) -> DataFrame:
    """(block, blob): per block and slice, the block's anchors that several documents have, and which are hot."""

    def keep(group: pd.DataFrame) -> pd.DataFrame:
        parts = [unpack(blob, "u8", "u1") for blob in group["blob"]]
        anchors = [np.cumsum(step, dtype=np.uint64) for step, _ in parts]
        known, place = np.unique(np.concatenate(anchors), return_inverse=True)
        docs = np.bincount(place, np.concatenate([d for _, d in parts]), len(known))
        out, at = [], 0
        for own in anchors:
            total = docs[place[at : at + len(own)]]
            at += len(own)
            kept = total > 1
            out.append(pack(own[kept], total[kept] >= hot) if kept.any() else None)
        return pd.DataFrame({"block": group["block"], "blob": out}).dropna()

    return counts.groupBy("slice").applyInPandas(keep, "block long, blob binary")


def _runs_of_blocks(blocks: DataFrame, slices: int, length: int, gram: int) -> DataFrame:
    """(slice, block, blob): distinct runs of windows with shared anchors, and the places where they lie."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, packed, lists in zip(*(batch[c].to_pylist() for c in ("block", "packed", "blobs")), strict=True):
                parts = [unpack(blob, "u8", "?") for blob in lists]
                known = np.concatenate([a for a, _ in parts])
                is_hot = np.concatenate([h for _, h in parts])[np.argsort(known)]
                known = np.sort(known)
                block = Block(packed)
                found: dict[int, tuple[dict[bytes, int], list, list, list, list]] = {}
                for text, doc, at, start, n, anchor in runs(block, length, gram):
                    place = np.minimum(np.searchsorted(known, anchor), len(known) - 1)
                    shared = known[place] == anchor
                    hot = shared & is_hot[place]
                    plain = shared & ~hot
                    doc_, at_, start_, n_, key = doc[plain], at[plain], start[plain], n[plain], anchor[plain]
                    if hot.any():
                        each = n[hot]
                        k = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                        own = np.repeat(at[hot], each) + k
                        whole = _hashes(text, length)[own] >> (np.uint64(64) - _BITS)
                        doc_ = np.append(doc_, np.repeat(doc[hot], each))
                        start_ = np.append(start_, np.repeat(start[hot], each) + k)
                        at_, n_, key = np.append(at_, own), np.append(n_, np.ones_like(own)), np.append(key, whole)
                    raw = text.tobytes()
                    columns = (_slice_of(key, slices), key & np.uint64(0xFFFF), doc_, at_, start_, n_ + length - 1)
                    for of_slice, sub, i, a, s, size in zip(*(c.tolist() for c in columns), strict=True):
                        texts, subs, which, owners, starts = found.setdefault(of_slice, ({}, [], [], [], []))
                        piece = raw[a : a + size]
                        if piece not in texts:
                            texts[piece] = len(subs)
                            subs.append(sub)
                        which.append(texts[piece])
                        owners.append(i)
                        starts.append(s)
                blobs = [
                    pack(
                        np.array([len(t) for t in texts], np.uint8),
                        np.array(which, np.uint32),
                        np.array(subs, np.uint16),
                        np.array(owners, np.uint32),
                        np.array(starts, np.uint32),
                        block.id[owners],
                        np.frombuffer(b"".join(texts), np.uint8),
                    )
                    for texts, subs, which, owners, starts in found.values()
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(found), pa.int64()), pa.array([number] * len(found), pa.int64()), pa.array(blobs, pa.binary())],
                    ["slice", "block", "blob"],
                )

    return blocks.mapInArrow(gather, "slice long, block long, blob binary")


def first_documents(texts: list[bytes], docs: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(windows of each text, by window the smallest document of the texts that have it), one text after the other.

    ``docs`` is the smallest document of each text. The texts are one shard: its suffix array puts equal
    windows side by side, with common prefixes of a window or more between neighbours.
    """
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    joined = np.frombuffer(b"\xff".join([*texts, b""]), np.uint8)
    start = np.cumsum(sizes + 1) - sizes - 1
    order = suffix_array(joined)
    common = permuted_prefixes(joined, order, length)
    of_place = np.full(len(joined), _LAST)
    windows = sizes - length + 1
    place = np.repeat(start - np.cumsum(windows) + windows, windows) + np.arange(windows.sum())
    of_place[place] = np.repeat(docs, windows)
    new = np.flatnonzero(common[order] < length)
    least = np.minimum.reduceat(of_place[order], new)
    of_place[order] = np.repeat(least, np.diff(np.append(new, len(order))))
    return windows, of_place[place]


def _ranges(runs_: DataFrame, length: int, shard: int) -> DataFrame:
    """(block, blob): documents of the block and ranges of bytes in them that go."""

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        parts = [unpack(blob, *_RUN_DTYPES) for blob in group["blob"]]
        number: dict[bytes, int] = {}
        subs, of_part = [], []
        for size, _, sub, _, _, _, data in parts:
            raw, ends = data.tobytes(), np.cumsum(size, dtype=np.int64)
            own = []
            for a, b, s in zip((ends - size).tolist(), ends.tolist(), sub.tolist(), strict=True):
                k = number.setdefault(raw[a:b], len(subs))
                if k == len(subs):
                    subs.append(s)
                own.append(k)
            of_part.append(np.array(own, dtype=np.int64))
        texts = list(number)
        docs = np.full(len(texts), _LAST)
        for own, (_, which, _, _, _, ids, _) in zip(of_part, parts, strict=True):
            np.minimum.at(docs, own[which], ids)
        sizes, subs = np.array([len(t) for t in texts], dtype=np.int64), np.array(subs, dtype=np.int64)
        shards = int(sizes.sum()) // shard + 1
        of_shard = subs * shards >> 16
        # Stretches of windows with one first document, by text.
        stretches = []
        for s in np.unique(of_shard).tolist():
            own = np.flatnonzero(of_shard == s)
            windows, least = first_documents([texts[k] for k in own], docs[own], length)
            start = np.cumsum(windows) - windows
            new = np.append(True, least[1:] != least[:-1])
            new[start] = True
            low = np.flatnonzero(new)
            of_text = np.repeat(np.arange(len(own)), windows)[low]
            high = np.append(low[1:], len(least)) - start[of_text]
            stretches.append((own[of_text], low - start[of_text], high, least[low]))
        text, low, high, first = map(np.concatenate, zip(*stretches, strict=True))
        order = np.argsort(text, kind="stable")
        low, high, first = low[order], high[order], first[order]
        n = np.bincount(text, minlength=len(texts))
        start = np.cumsum(n) - n
        out = []
        for own, (_, which, _, owners, starts, ids, _) in zip(of_part, parts, strict=True):
            each = n[own[which]]
            k = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each) + np.repeat(start[own[which]], each)
            gone = first[k] < np.repeat(ids, each)
            at = np.repeat(starts, each)[gone].astype(np.int64)
            k = k[gone]
            packed = pack(np.repeat(owners, each)[gone], (at + low[k]).astype("u4"), (at + high[k] + length - 1).astype("u4"))
            out.append(packed if len(k) else None)
        return pd.DataFrame({"block": group["block"], "blob": out}).dropna()

    return runs_.groupBy("slice").applyInPandas(compare, "block long, blob binary")


def _spans(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal ranges from ranges that may overlap or touch."""
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order]) if len(high) else high
    new = np.flatnonzero(np.append(True, low[1:] > high[:-1])) if len(low) else np.zeros(0, dtype=np.int64)
    return low[new], high[np.append(new[1:], len(low)) - 1] if len(new) else high


def _cut(blocks: DataFrame, length: int) -> DataFrame:
    """(id, n_bytes, low, high, kept) of every document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed, lists in zip(batch["packed"].to_pylist(), batch["blobs"].to_pylist(), strict=True):
                block = Block(packed)
                parts = [unpack(blob, "u4", "u4", "u4") for blob in lists or []] or [np.zeros((3, 0), np.uint32)]
                doc, low, high = (np.concatenate(x).astype(np.int64) for x in zip(*parts, strict=True))
                order = np.argsort(doc, kind="stable")
                doc, low, high = doc[order], low[order], high[order]
                first = np.searchsorted(doc, np.arange(len(block.id) + 1)).tolist()
                rows, size = [], 0
                for i, (a, b, same) in enumerate(zip(block.start.tolist(), block.end.tolist(), block.same.tolist(), strict=True)):
                    if block.id[i] > block.id[same] and b - a >= length:
                        lows, highs = [0], [b - a]
                    else:
                        lows, highs = _spans(low[first[same] : first[same + 1]], high[first[same] : first[same + 1]])
                    kept = b"".join(block.raw[a + x : a + y] for x, y in zip([0, *highs], [*lows, b - a], strict=True))
                    rows.append((None if block.id[i] == _LAST else int(block.id[i]), b - a, lows, highs, kept))
                    size += len(kept)
                    if size > 4 << 20:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)

    return blocks.mapInArrow(cut, "id long, n_bytes long, low array<long>, high array<long>, kept binary")


def _spans(low: np.ndarray, high: np.ndarray) -> tuple[list[int], list[int]]:
    """Maximal ranges from ranges that may overlap or touch."""
    if not len(low):
        return [], []
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    new = np.flatnonzero(np.append(True, low[1:] > high[:-1]))
    return low[new].tolist(), high[np.append(new[1:], len(low)) - 1].tolist()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
    arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["id", "n_bytes", "low", "high", "kept"])


def without_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    block: int = BLOCK,
    hot: int = HOT,
    shard: int = SHARD,
) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_bytes``, ``spans`` (start, end) of the bytes that go, and ``kept``.

    ``length`` is from ``GRAM`` to 190. ``block``, ``shard`` and ``hot`` change cost only: bytes of a
    packed block, bytes of a suffix array, and from how many documents on an anchor is split.
    """
    if not GRAM <= length <= 190:
        raise ValueError(f"length must be from {GRAM} to 190")
    spark = docs.sparkSession
    ready_for_python(spark)
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    total = docs.select(F.sum(F.octet_length(text_col))).first()[0] or 0
    # Fewer buckets than shuffle partitions, and Spark shuffles the blocks after all.
    slices, buckets = max(12, -(-total // SLICE)), max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET))

    texts = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("bytes"))
    blocks = _bucketed(_packed(texts, block), buckets)

    counts = _anchor_counts(blocks, slices, length, GRAM)
    shared = _shared_anchors(counts, hot).groupBy("block").agg(F.collect_list("blob").alias("blobs"))
    found = _runs_of_blocks(blocks.join(shared.hint("shuffle_hash"), "block"), slices, length, GRAM)
    gone = _ranges(found, length, shard).groupBy("block").agg(F.collect_list("blob").alias("blobs"))
    cut = _cut(blocks.join(gone.hint("shuffle_hash"), "block", "left"), length)
    spans = F.transform(F.arrays_zip("low", "high"), lambda s: F.struct(s["low"].alias("start"), s["high"].alias("end")))
    return cut.select(F.col("id").alias(id_col), "n_bytes", spans.alias("spans"), "kept")
