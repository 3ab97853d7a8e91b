"""Words of documents that lie in passages of benchmark items, found by a prefix-filtered set join.

An item's windows are its runs of ``WINDOW`` words; an item of fewer words, but not none, is one window.
A window is a set of word shingles that a document must contain whole, in place. As all of them must
be there, its shortest necessary prefix, in the order from rare to common, is a single shingle: the one
that occurs least often in all documents. Documents are joined with those prefix shingles only. The
offset of the shingle in the window and the length of the document bound where the window may lie, and
the words there are then compared one by one.

The documents are split into words once. What that pass keeps of a document is its length and the
shingles that may occur in some item (a bit set of fixed size says which), each with its surroundings.
How often a shingle occurs is counted over these, hence over all documents.

Null text has no words. An item without words has no windows; a null item_id is not listed or counted,
its windows still hit. Rows that repeat an item_id are one item. Every document row gets a row, those
with null or repeated ids as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import Slots, alnum_words, holds, mix, ready_for_python, slots_of
from tidemark.sources.shared import stage

WINDOW, SHINGLE = 10, 5


def shingles(words: list[bytes], k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words, by place."""
    count = len(words) - k + 1
    if count < 1:
        return np.empty(0, dtype=np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    run = np.full(count, k, dtype=np.uint64)
    for j in range(k):
        run = run * np.uint64(0x9E3779B97F4A7C15) + each[j : j + count]
    return mix(run)


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int, shingle: int) -> DataFrame:
    """Per item and window: its words joined by blanks, their number and the shingles by offset."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for item, text in zip(batch["item_id"], batch["text"], strict=True):
                words = alnum_words(text)
                size = min(window, len(words))
                for start in range(len(words) - size + 1 if words else 0):
                    own = words[start : start + size]
                    found = shingles(own, min(shingle, size)).view(np.int64)
                    rows.append((item, b" ".join(own).decode(), size, found))
            yield pd.DataFrame(rows, columns=["item_id", "window", "size", "shingles"])

    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")
    # Ids travel as text, so a null stays one.
    ids = F.col(id_col).cast("string").alias("item_id")
    return items.select(ids, text).mapInPandas(cut, "item_id string, window string, size int, shingles array<bigint>")


def document_hits(docs: DataFrame, id_col: str, text_col: str, slots: Slots, lengths: list[int], window: int, shingle: int) -> DataFrame:
    """Per document row: its words' number and its shingles that some item may have."""
    sent = slots.sent

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packed = sent.value
        for batch in batches:
            out = []
            for text in batch["text"]:
                words = alnum_words(text)
                keys, places, firsts, around = [], [], [], []
                for k in lengths:
                    runs = shingles(words, k)
                    reach = window - k if k == shingle else 0  # a shorter shingle is a whole window
                    for p in np.flatnonzero(holds(packed, slots_of(runs))).tolist():
                        first = max(0, p - reach)
                        keys.append(runs[p].astype(np.int64))
                        places.append(p)
                        firsts.append(first)
                        around.append(b" ".join(words[first : p + k + reach]).decode())
                out.append((len(words), keys, places, firsts, around))
            found = pd.DataFrame(out, columns=["n_words", "shingle", "place", "first", "around"])
            yield pd.concat([batch[["id", "text_key"]].reset_index(drop=True), found], axis=1)

    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(
        F.col(id_col).cast("string").alias("id"),
        F.xxhash64(text_col).alias("text_key"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
    )
    found = texts.mapInPandas(
        scan,
        "id string, text_key bigint, n_words bigint, shingle array<bigint>, place array<int>, first array<int>, around array<string>",
    )
    # The number of the row is made before it is written, so all that follows sees the same one.
    return stage(found.withColumns({"row": F.monotonically_increasing_id(), "id": F.col("id").cast(kind)}), "scanned")


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
) -> DataFrame:
    """Per document row: id, text_key (xxhash64 of the text), n_words, n_hit, n_items, items (ids as text, sorted)."""
    ready_for_python(docs.sparkSession)
    named = stage(item_windows(items, item_id_col, item_text_col, window, shingle), "windows")
    windows = named.dropDuplicates(["window"])
    needed = windows.select("window", "size", F.posexplode("shingles").alias("offset", "shingle"))
    lengths = sorted(min(shingle, r["size"]) for r in named.select("size").distinct().collect())  # at most ``window``
    scanned = document_hits(docs, id_col, text_col, Slots(needed, "shingle"), sorted(set(lengths)), window, shingle)
    zipped = F.explode(F.arrays_zip("shingle", "place", "first", "around")).alias("hit")
    hits = scanned.select("row", "n_words", zipped).select("row", "n_words", "hit.*")

    counts = hits.groupBy("shingle").agg(F.count("*").alias("times"))
    rarest = F.min(F.struct("times", "offset", "shingle")).alias("rarest")
    ranked = needed.join(counts, "shingle", "left").withColumn("times", F.coalesce("times", F.lit(0)))
    prefix = ranked.groupBy("window", "size").agg(rarest).where("rarest.times > 0").select("window", "size", "rarest.*")
    prefix = stage(prefix.drop("times"), "prefixes")

    start = F.col("place") - F.col("offset")
    bounded = (start >= F.col("first")) & (start + F.col("size") <= F.col("n_words"))
    same = F.array_join(F.slice(F.split("around", " "), start - F.col("first") + 1, F.col("size")), " ") == F.col("window")
    matched = stage(
        hits.join(prefix, "shingle").where(bounded & same).select("row", "window", start.alias("start"), "size").distinct(), "matches"
    )

    # New words of a span: those past the furthest end of all spans that start earlier.
    before = W.partitionBy("row").orderBy("start", "size").rowsBetween(W.unboundedPreceding, -1)
    end = F.col("start") + F.col("size")
    reached = F.coalesce(F.max(end).over(before), F.lit(0))
    spans = matched.select("row", "start", "size").distinct()
    covered = spans.withColumn("new", F.greatest(end - F.greatest(reached, F.col("start")), F.lit(0)))
    n_hit = covered.groupBy("row").agg(F.sum("new").alias("n_hit"))
    owners = named.where(F.col("item_id").isNotNull()).select("window", "item_id").distinct()
    listed = matched.select("row", "window").distinct().join(owners, "window").select("row", "item_id").distinct()
    listed = listed.groupBy("row").agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    result = scanned.select("row", "id", "text_key", "n_words").join(n_hit, "row", "left").join(listed, "row", "left")
    return result.select(
        F.col("id").alias(id_col),
        "text_key",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` with no word in a benchmark passage, with their columns."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    hit = contamination(docs, items, **options).where("n_hit > 0")
    hit = hit.select(F.col(id_col).alias("__id"), F.col("text_key").alias("__key")).distinct()
    same = docs[id_col].eqNullSafe(hit["__id"]) & (F.xxhash64(docs[text_col]) == hit["__key"])
    return docs.join(hit, same, "left_anti")
