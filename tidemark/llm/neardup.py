"""Near-duplicate documents: MinHash with tensored banding, verified on whole shingle sets.

Two small collections of half keys are computed per document, ``half_keys`` each, a half key being
``width`` minhashes. Every pair of a half key of the first and one of the second collection is the key
of one hash table. ``half_keys`` squared tables thus take 2 * half_keys * width minhashes, where one
key of 2 * width minhashes per table would take half_keys squared times that. Two sets of similarity s
share a table with probability (1 - (1 - s^width)^half_keys)^2: 0.9996 at 0.8 with 12 and 3.

The steps:

1. Documents with the same shingle set are one class, known by its smallest id, so copies cost a row.
2. In every table a class is paired with the smallest class of its bucket, never with all of it.
3. Pairs are verified on whole sets; links give components. Each class first takes its pair with the
   smallest partner; further pairs are verified only while they lie in different components.
4. In a bucket that then still spans several components, all pairs across components are verified too,
   block by block within tasks, which give one link for two components. So within a bucket no link is
   missed that would change a component, and no pairs are emitted.

Null text or text without words has the empty set, which is linked with nothing. A row without id keeps
n_shingles, has no component_id and is kept. Rows that repeat an id are one document: what links one of
them links all. Ids are whole numbers, or read as such; others stop the run.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Slots, blank_words, holds, mix, ready_for_python, slot_of
from tidemark.llm.components import components
from tidemark.sources.shared import stage

SHINGLE, PERCENT, HALF_KEYS, WIDTH = 5, 80, 12, 3
_AT_ONCE = 1 << 12
_BLOCK = 1 << 19  # shingles of a block that is compared with another in one task


def shingle_set(raw: bytes, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``k`` words; of fewer words, of all of them."""
    words = blank_words(raw)
    k = min(k, len(words))
    if not k:
        return np.empty(0, dtype=np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    count = len(words) - k + 1
    run = np.full(count, k, dtype=np.uint64)
    for j in range(k):
        run = run * np.uint64(0x9E3779B97F4A7C15) + each[j : j + count]
    return np.unique(mix(run))


@lru_cache(8)
def _functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    """The odd factors and the shifts of ``count`` hash functions, the same in every task."""
    seeds = np.random.default_rng(20240229).integers(1, 1 << 63, size=(2, count), dtype=np.uint64)
    return seeds[0] | np.uint64(1), seeds[1]


def half_keys_of(found: np.ndarray, half_keys: int, width: int) -> np.ndarray:
    """The 2 * half_keys half keys of a non-empty set, each a hash of its place and ``width`` minhashes."""
    count = 2 * half_keys * width
    factors, shifts = _functions(count)
    least = np.full(count, np.iinfo(np.uint64).max)
    for at in range(0, len(found), _AT_ONCE):
        part = found[at : at + _AT_ONCE]
        values = part[None, :] * factors[:, None] + shifts[:, None]
        values ^= values >> np.uint64(32)
        least = np.minimum(least, (values * np.uint64(0x9FB21C651E98DF25)).min(axis=1))
    keys = np.arange(2 * half_keys, dtype=np.uint64)
    for one in least.reshape(2 * half_keys, width).T:
        keys = keys * np.uint64(0x9E3779B97F4A7C15) + one
    return mix(keys)


def signatures(docs: DataFrame, id_col: str, text_col: str, shingle: int, half_keys: int, width: int) -> DataFrame:
    """Per document row: the size of its set, a 128-bit digest of the set, and the half keys."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                found = shingle_set(text, shingle)
                if not len(found):
                    rows.append((0, None, None, None))
                    continue
                keys = half_keys_of(found, half_keys, width).view(np.int64)
                digest = xxhash.xxh3_128_digest(found.tobytes())
                rows.append((len(found), digest, keys[:half_keys], keys[half_keys:]))
            found = pd.DataFrame(rows, columns=["n_shingles", "digest", "first", "second"])
            yield pd.concat([batch[["id"]].reset_index(drop=True), found], axis=1)

    texts = _texts(docs, id_col, text_col).withColumn("id", F.col("id").cast("string"))
    made = texts.mapInPandas(
        scan, "id string, n_shingles bigint, digest binary, first array<bigint>, second array<bigint>"
    )
    return made.withColumn("id", F.col("id").cast("long"))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))


def table_keys(classes: DataFrame) -> DataFrame:
    """Every class once for each of its tables: the keys are all pairs of its two kinds of half keys."""
    pairs = F.transform("first", lambda a: F.transform("second", lambda b: F.xxhash64(a, b)))
    return classes.select("id", "size", F.explode(F.flatten(pairs)).alias("key"))


def _sets(docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame, shingle: int) -> DataFrame:
    """Shingle sets of the wanted ids. Texts of other documents are not split and do not travel."""
    sent = Slots(wanted, "id").sent

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packed = sent.value
        for batch in batches:
            batch = batch[holds(packed, batch["slot"].to_numpy(dtype=np.uint64))]
            found = [shingle_set(t, shingle).view(np.int64) for t in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "found": pd.Series(found, index=batch.index, dtype=object)})

    texts = _texts(docs, id_col, text_col).where("id is not null").withColumn("slot", slot_of(F.col("id")))
    return texts.mapInPandas(scan, "id bigint, found array<bigint>").join(wanted, "id", "left_semi")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose whole sets are similar enough: 100 * intersection >= percent * union."""
    left = pairs.join(sets.select(F.col("id").alias("v"), F.col("found").alias("of_v")), "v")
    both = left.join(sets.select(F.col("id").alias("u"), F.col("found").alias("of_u")), "u")
    shared = F.size(F.array_intersect("of_u", "of_v"))
    union = F.size("of_u") + F.size("of_v") - shared
    return stage(both.where(100 * shared >= percent * union).select("u", "v").distinct(), "links")


def _joined(found: DataFrame, links: DataFrame) -> DataFrame:
    """Components once more links are known. These mostly are few or none, so only what they touch is done anew."""
    if links.isEmpty():
        return found
    u = found.select(F.col("node").alias("u"), F.col("component").alias("of_u"))
    v = found.select(F.col("node").alias("v"), F.col("component").alias("of_v"))
    lifted = links.join(u, "u", "left").join(v, "v", "left").select(
        F.coalesce("of_u", "u").alias("u"), F.coalesce("of_v", "v").alias("v")
    )
    # Components of components, and nodes that had none.
    above = components(lifted).select("node", F.col("component").alias("above"))
    kept = found.join(above.withColumnRenamed("node", "component"), "component", "left").select(
        "node", F.coalesce("above", "component").alias("component")
    )
    return stage(kept.union(above.select("node", F.col("above").alias("component"))).distinct(), "components")


def _across(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs whose ends lie in different components."""
    u = found.select(F.col("node").alias("u"), F.col("component").alias("of_u"))
    v = found.select(F.col("node").alias("v"), F.col("component").alias("of_v"))
    named = pairs.join(u, "u", "left").join(v, "v", "left")
    return named.where(F.coalesce("of_u", "u") != F.coalesce("of_v", "v")).select("u", "v")


def _across_buckets(wide: DataFrame, split: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components that meet in the ``split`` buckets; ``wide`` has the buckets' members.

    Members meet by half key of the first collection, so tables that share one are searched together.
    The component with most members there is searched by all others, the probes; probes and members are
    dealt into blocks by the size of their sets, and each task compares one block with another. Of the
    pairs found, one for each two components is kept, so nothing is emitted that grows with pairs.
    """
    left = stage(wide.join(split, "key", "left_semi").select("id", "component").distinct(), "split-members")
    known = left.join(classes.select("id", "size", "first", "second"), "id")
    halves = F.transform("first", lambda a: F.struct(a.alias("half"), F.transform("second", lambda b: F.xxhash64(a, b)).alias("keys")))
    tables = known.select("id", F.explode(halves).alias("h")).select("id", "h.half", F.explode("h.keys").alias("key"))
    member = tables.join(split, "key", "left_semi").select("half", "id").distinct()
    member = stage(member.join(known.select("id", "component", "size"), "id"), "half-members")

    of_component = member.groupBy("half", "component").agg(F.count("*").alias("n"), F.sum("size").alias("load"))
    largest = F.max(F.struct("n", "load", "component")).alias("main")
    meeting = of_component.groupBy("half").agg(largest, F.sum("load").alias("load"), F.count("*").alias("kinds")).where("kinds > 1")
    blocks = lambda load: F.ceil(load / _BLOCK).cast("int")
    meeting = meeting.select(
        "half",
        F.col("main.component").alias("main"),
        blocks(F.col("load")).alias("member_blocks"),
        blocks(F.col("load") - F.col("main.load")).alias("probe_blocks"),
    )
    dealt = member.join(stage(meeting, "half-groups"), "half")
    place = lambda n: F.pmod(F.xxhash64("id", F.lit(1)), n).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    members = dealt.select("half", place(F.col("member_blocks")).alias("mb"), each(F.col("probe_blocks")).alias("pb"), F.lit(0).alias("probe"), "id", "component")
    probes = dealt.where("component <> main").select(
        "half", each(F.col("member_blocks")).alias("mb"), place(F.col("probe_blocks")).alias("pb"), F.lit(1).alias("probe"), "id", "component"
    )
    tasks = members.unionByName(probes).join(known.select("id", "first", "second"), "id").join(sets, "id")
    tasks = tasks.repartition("half", "mb", "pb").sortWithinPartitions("half", "mb", "pb", "probe")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        last = None
        for batch in batches:
            for key, part in batch.groupby(["half", "mb", "pb"], sort=False):
                if key != last and held:
                    yield _links_of(pd.concat(held), percent)
                    held = []
                held.append(part)
                last = key
        if held:
            yield _links_of(pd.concat(held), percent)

    return stage(tasks.mapInPandas(search, "u bigint, v bigint").distinct(), "last-links")


def _links_of(group: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links between different components of one block of members and one of probes."""
    half = group["half"].iloc[0]
    members, probes = group[group["probe"] == 0], group[group["probe"] == 1]
    links: list[tuple[int, int]] = []
    if len(members) and len(probes):
        names = {c: i for i, c in enumerate(pd.unique(group["component"]))}
        root = np.arange(len(names))  # of each component, as links merge them
        owner_of = members["component"].map(names).to_numpy()
        first, second = np.stack(members["first"].to_list()), np.stack(members["second"].to_list())
        sizes = members["found"].map(len).to_numpy()
        shingles = np.concatenate(members["found"].to_list())
        order = np.argsort(shingles, kind="stable")
        shingles, owners = shingles[order], np.repeat(np.arange(len(members)), sizes)[order]
        ids = members["id"].to_numpy()
        for p in probes.itertuples(index=False):
            own = names[p.component]
            size = len(p.found)
            shared = first == np.asarray(p.first)
            # A pair is compared where it meets for the first time, and only if it shares a table there.
            at = shared.argmax(axis=1)
            here = shared.any(axis=1) & (first[np.arange(len(first)), at] == half) & (second == np.asarray(p.second)).any(axis=1)
            here &= 100 * np.minimum(sizes, size) >= percent * np.maximum(sizes, size)
            here &= root[owner_of] != root[own]
            if not here.any():
                continue
            low, high = np.searchsorted(shingles, p.found, "left"), np.searchsorted(shingles, p.found, "right")
            spans = high - low
            places = np.repeat(low - np.cumsum(spans) + spans, spans) + np.arange(spans.sum())
            both = np.bincount(owners[places], minlength=len(members))
            for i in np.flatnonzero(here & (100 * both >= percent * (size + sizes - both))):
                if root[owner_of[i]] != root[own]:
                    root[root == root[owner_of[i]]] = root[own]
                    links.append((max(p.id, ids[i]), min(p.id, ids[i])))
    return pd.DataFrame(links, columns=["u", "v"], dtype="int64")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    half_keys: int = HALF_KEYS,
    width: int = WIDTH,
) -> DataFrame:
    """Per document row: its id, n_shingles, component_id (smallest id that links lead to), kept."""
    ready_for_python(docs.sparkSession)
    signed = stage(signatures(docs, id_col, text_col, shingle, half_keys, width), "signatures")
    able = signed.where("id is not null and n_shingles > 0")
    least = F.min(F.struct("id", F.col("n_shingles").alias("size"), "first", "second")).alias("least")
    classes = stage(able.groupBy("digest").agg(least).select("digest", "least.*"), "classes")

    keys = table_keys(classes)
    smallest = F.min(F.struct("id", "size")).alias("least")
    buckets = keys.groupBy("key").agg(smallest, F.count("*").alias("members")).where("members > 1")
    buckets = stage(buckets.select("key", "members", F.col("least.id").alias("v"), F.col("least.size").alias("v_size")), "buckets")
    shared = stage(keys.join(buckets, "key"), "bucket-members")

    near = 100 * F.least("size", "v_size") >= percent * F.greatest("size", "v_size")
    pairs = shared.where((F.col("id") != F.col("v")) & near).select(F.col("id").alias("u"), "v").distinct()
    pairs = stage(pairs, "pairs")
    wanted = stage(shared.select("id").distinct(), "wanted")
    sets = stage(_sets(docs, id_col, text_col, wanted, shingle), "sets")

    first = _linked(pairs.groupBy("u").agg(F.min("v").alias("v")), sets, percent)
    # The classes of one id are one document: those it stands for already, the others by an edge to what stands for them.
    repeated = stage(signed.where("id is not null").groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"), "repeated")
    classes_of = able.select("id", "digest").join(repeated, "id", "left_semi").distinct()
    same = classes_of.join(classes.select("digest", F.col("id").alias("v")), "digest").select(F.col("id").alias("u"), "v")
    found = components(first.select("u", "v").union(same))
    more = _linked(_across(pairs, found), sets, percent)
    found = _joined(found, more)

    # Buckets of three and more that span components: every pair across, compared within tasks.
    wide = shared.where("members > 2").join(found, F.col("id") == F.col("node"), "left")
    wide = wide.select("key", "id", F.coalesce("component", "id").alias("component"))
    split = wide.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b").select("key")
    last = _across_buckets(wide, stage(split, "split-buckets"), classes, sets, percent)
    found = _joined(found, last)

    of_class = classes.join(found, F.col("id") == F.col("node"), "left")
    of_class = stage(of_class.select("digest", F.coalesce("component", "id").alias("component")), "class-components")
    # A row without shingles has no class, but others of its id may.
    of_id = repeated.join(found, F.col("id") == F.col("node")).select("id", "component")
    bare = signed.where("digest is null").join(of_id, "id", "left").select("id", "n_shingles", "component")
    result = signed.where("digest is not null").join(of_class, "digest", "left").select("id", "n_shingles", "component").union(bare)
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return result.select(
        F.col("id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stand for their group, with their columns."""
    id_col = options.get("id_col", "doc_id")
    gone = near_duplicates(docs, **options).where(~F.col("kept")).select(F.col(id_col).alias("__id")).distinct()
    return docs.join(gone, docs[id_col].cast("long") == gone["__id"], "left_anti")
