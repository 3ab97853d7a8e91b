"""Keyed merges into a table that has no row-level DML: the result is the table's next state.

Three plans give the same rows:

* ``probe``: the change set is below the session's broadcast threshold and a small part of the target.
  Stored rows look it up and are never shuffled; the new rows come from an anti join with the few
  matched keys.
* ``outer``: otherwise. One full outer join, each side read and shuffled once. It holds the rows of
  one key in memory, which is nothing while the key is all but unique.
* ``split``: in place of ``outer`` where the table may hold very many rows of one key. A left and an
  anti join, which adaptive execution can split; stored keys are combined before they are shuffled,
  and the two joins share one shuffle of the change set.

Both sides of ``outer`` may already be laid out by a column that a key all but settles, say items by
their order after a join with orders. Named as ``beside``, it lets rows be merged where they lie, which
saves the two widest shuffles. Nothing is taken for granted: keys found under several values of the
column, and values with very many rows, are merged apart by ``outer`` or ``split``.

Rows with a NULL key never match and take no part in any of the joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import business_columns, insert_stamp, split_on_keys
from tidemark.functions.sizes import below_broadcast_threshold, planned_bytes

# A change set this many times smaller than the target is worth looking up.
SMALL_PART = 4
# A value of ``beside`` with so many rows, and this share of all, is not left to one task.
CROWD, CROWD_SHARE = 100_000, 0.01

_NEW = "__new_"
_STORED = "__stored"
_MET, _FOUND, _HASH = "__met", "__found", "__hash"


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    load_id: str,
    load_ts: datetime,
    many_copies: bool = False,
    plan: str = "auto",
    matched: DataFrame | None = None,
    beside: str | None = None,
    among: DataFrame | None = None,
) -> DataFrame:
    """Slowly changing dimension type 1: overwrite the matches, add the rest, keep all others.

    A match takes every business value of its source row, changed or not, and is restamped; its
    creation stamp stays. Columns are matched by name and cast to the target's types. Several source
    rows for one target row are an error of the input; ``duplicate_matches`` finds them.
    ``many_copies`` says that the target may hold very many rows of one key; it changes the plan, not
    the result. ``matched`` are the target's keys that occur in the source, if the caller has them already.
    ``beside`` changes the plan as well: a column by which both sides are laid out and which rows of one key
    nearly always share. ``among`` holds every pair of key and ``beside`` that target and source have, and may
    hold more; it is read at once, and by default is made of the two.
    """
    plan = _pick(plan, target, source, many_copies)
    stamp = insert_stamp(target, load_id, load_ts)
    types = {f.name: f.dataType for f in target.schema.fields}
    incoming = source.select(*[F.col(c).cast(types[c]).alias(c) for c in business_columns(target)])
    known, unkeyed_old = split_on_keys(target, keys)
    fresh, unkeyed_new = split_on_keys(incoming, keys)

    # The same columns on every branch, so that one shuffle of the source can serve two joins.
    new = fresh.select(*[F.col(c).alias(_NEW + c) for c in fresh.columns])
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(_NEW + k) for k in keys])
    if beside is not None and plan in ("outer", "split"):
        if among is None:
            among = known.select(beside, *keys).unionByName(fresh.select(beside, *keys))
        among = among.select(*[F.col(c).cast(types[c]).alias(c) for c in dict.fromkeys([beside, *keys])])
        known, known_apart, fresh, fresh_apart = _told_apart(known, fresh, keys, beside, among)
        pieces = [_overwritten(_met_in_place(known, fresh, keys, beside), target, keys, stamp)]
        if known_apart is not None:
            pieces.append(upsert(known_apart, fresh_apart, keys, load_id, load_ts, plan=plan))
    elif plan == "outer":
        pieces = [_overwritten(known.withColumn(_STORED, F.lit(True)).join(new, on, "full_outer"), target, keys, stamp)]
    else:
        if matched is not None:
            stored = matched.select(*keys)
        else:
            stored = matched_keys(known, fresh, keys) if plan == "probe" else known.select(*keys)
        added = new.join(stored.distinct(), on, "left_anti").select(*[F.col(_NEW + c).alias(c) for c in fresh.columns])
        looked_up = known.withColumn(_STORED, F.lit(True)).join(new, on, "left_outer")
        pieces = [_overwritten(looked_up, target, keys, stamp), _stamped(added, target.columns, stamp)]
    if unkeyed_old is not None:
        pieces.append(unkeyed_old)
    if unkeyed_new is not None:
        pieces.append(_stamped(unkeyed_new, target.columns, stamp))
    return reduce(DataFrame.unionByName, pieces)


def insert_absent(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    eff_ts: datetime,
    load_id: str,
    load_ts: datetime,
    surrogate: str | None = None,
) -> DataFrame:
    """Add source rows whose key has no open version; change nothing else."""
    new = absent_rows(target, source, keys, eff_ts, load_id, load_ts, surrogate)
    return target.unionByName(new, allowMissingColumns=surrogate is not None)


def absent_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    eff_ts: datetime,
    load_id: str,
    load_ts: datetime,
    surrogate: str | None = None,
) -> DataFrame:
    """Only the rows ``insert_absent`` adds, without the surrogate key."""
    columns = [c for c in target.columns if c != surrogate]
    types = {f.name: f.dataType for f in target.schema.fields}
    incoming = source.select(*[F.col(c).cast(types[c]).alias(c) for c in business_columns(target, surrogate)])
    fresh, unkeyed = split_on_keys(incoming, keys)
    opened = target.where(F.col("dw_eff_end_dt").isNull())
    stored = matched_keys(opened, fresh, keys) if _small(opened, fresh) else opened.select(*keys)
    new = fresh.join(stored.distinct(), list(keys), "left_anti")
    if unkeyed is not None:
        new = new.unionByName(unkeyed)
    return _stamped(new, columns, insert_stamp(target, load_id, load_ts, eff_ts))


def repeated_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one source row, and how many.

    The count is combined before its shuffle, so a key with very many copies is no hot spot.
    """
    whole, _ = split_on_keys(source.select(*keys), keys)
    return whole.groupBy(*keys).agg(F.count("*").alias("source_rows")).where("source_rows > 1")


def duplicate_matches(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys in ``target`` that more than one source row would update: a merge must refuse those."""
    repeated = repeated_keys(source, keys)
    return repeated.join(matched_keys(target, repeated, keys), list(keys), "left_semi")


def matched_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target keys that occur in the source."""
    return target.select(*keys).join(source.select(*keys), list(keys), "left_semi")


def within_key_range(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``target`` that can match: every key lies between the smallest and the largest of ``source``.

    One small aggregate of the source gives literals, so the condition reaches the target's scan, where row
    groups and files outside the range are passed over. Rows with a NULL key match nothing and are left
    out, and so is everything if the source has no whole key. For a source that is stored or cheap.
    """
    types = {f.name: f.dataType for f in target.schema.fields}
    fresh, _ = split_on_keys(source.select(*[F.col(k).cast(types[k]).alias(k) for k in keys]), keys)
    ends = [f(k).alias(f"{name}_{i}") for i, k in enumerate(keys) for name, f in (("low", F.min), ("high", F.max))]
    found = fresh.agg(*ends).first()
    if found["low_0"] is None:
        return target.where(F.lit(False))
    # A value that goes back as a literal must be typed as the column, or the scan would see a cast.
    literal = lambda name, i: F.lit(found[f"{name}_{i}"]).cast(types[keys[i]])
    in_range = [(F.col(k) >= literal("low", i)) & (F.col(k) <= literal("high", i)) for i, k in enumerate(keys)]
    return target.where(reduce(lambda a, b: a & b, in_range))


def _small(target: DataFrame, source: DataFrame) -> bool:
    return below_broadcast_threshold(source) and planned_bytes(source) * SMALL_PART <= planned_bytes(target)


def _pick(plan: str, target: DataFrame, source: DataFrame, many_copies: bool) -> str:
    if plan not in ("auto", "probe", "outer", "split"):
        raise ValueError(f"plan must be 'auto', 'probe', 'outer' or 'split', not {plan!r}")
    if plan != "auto":
        return plan
    if _small(target, source):
        return "probe"
    return "split" if many_copies else "outer"


def _told_apart(
    known: DataFrame, fresh: DataFrame, keys: Sequence[str], beside: str, among: DataFrame
) -> tuple[DataFrame, DataFrame | None, DataFrame, DataFrame | None]:
    """Of both sides the rows to merge where they lie, and those to merge apart: ``None`` if there are none.

    A key goes one way with all its rows. It goes apart if it occurs with several values of ``beside`` or
    with none; its hash stands for it, so a few other keys may go along, which changes nothing but the way.
    """
    from tidemark.sources.shared import stage  # not above: sources import this module

    key, place = F.xxhash64(*keys), F.col(beside)
    among, _ = split_on_keys(among, keys)
    ends = [F.min(place).alias("low"), F.max(place).alias("high"), F.max(place.isNull()).alias("unplaced")]
    spread = among.select(key.alias(_HASH), place).groupBy(_HASH).agg(*ends)
    spread = stage(spread.where("low <> high or unplaced").select(_HASH), "spread-keys")
    often = [v for v in among.freqItems([beside], CROWD_SHARE).first()[0] if v is not None]
    crowd = among.where(place.isin(often)).groupBy(beside).agg(F.count("*").alias("rows")).where(F.col("rows") > CROWD)
    crowd = [row[0] for row in crowd.collect()]
    if not crowd and spread.isEmpty():
        return known, None, fresh, None
    crowded = F.coalesce(place.isin(crowd), F.lit(False))

    def ways(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        of_spread = key == F.col(_HASH)
        roomy = rows.where(~crowded)
        apart = rows.where(crowded).unionByName(roomy.join(spread, of_spread, "left_semi"))
        return roomy.join(spread, of_spread, "left_anti"), apart

    return (*ways(known), *ways(fresh))


def _met_in_place(known: DataFrame, fresh: DataFrame, keys: Sequence[str], beside: str) -> DataFrame:
    """The full outer join of ``upsert`` for rows of which those of a key share ``beside``, without a shuffle.

    A union keeps the layout of its sides and so does a window over ``beside`` and the keys. Stored rows
    take the new ones of their key; new rows go on by themselves only if no row of their key is stored.
    """
    both = known.withColumn(_STORED, F.lit(True)).unionByName(fresh, allowMissingColumns=True)
    of_key = Window.partitionBy(*dict.fromkeys([beside, *keys]))
    is_stored, own = F.col(_STORED).isNotNull(), F.struct(*fresh.columns)
    met = both.withColumn(_MET, F.max(_STORED).over(of_key))
    met = met.withColumn(_FOUND, F.collect_list(F.when(~is_stored & F.col(_MET), own)).over(of_key))
    met = met.where(is_stored | F.col(_MET).isNull()).withColumn(_NEW, F.explode_outer(_FOUND))
    new = F.when(is_stored, F.col(_NEW)).otherwise(own)
    return met.select(*known.columns, _STORED, *[new[c].alias(_NEW + c) for c in fresh.columns])


def _overwritten(joined: DataFrame, target: DataFrame, keys: Sequence[str], stamp: dict[str, Column]) -> DataFrame:
    """Per joined row the side that holds: the source where there is one, else the target."""
    # No key is NULL here, so only an absent source row has none.
    in_source, in_target = F.col(_NEW + keys[0]).isNotNull(), F.col(_STORED).isNotNull()
    audit = {
        "dw_create_dt": F.when(in_target, F.col("dw_create_dt")).otherwise(stamp["dw_create_dt"]),
        "dw_mdfctn_dt": F.when(in_source, stamp["dw_mdfctn_dt"]).otherwise(F.col("dw_mdfctn_dt")),
        "dw_load_id": F.when(in_target, F.col("dw_load_id")).otherwise(stamp["dw_load_id"]),
        "dw_update_id": F.when(in_source & in_target, stamp["dw_load_id"]).otherwise(F.col("dw_update_id")),
    }
    return joined.select(
        *[
            audit[c].alias(c) if c in audit else F.when(in_source, F.col(_NEW + c)).otherwise(F.col(c)).alias(c)
            for c in target.columns
        ]
    )


def _stamped(rows: DataFrame, columns: Sequence[str], stamp: dict[str, Column]) -> DataFrame:
    return rows.select(*[stamp[c].alias(c) if c in stamp else F.col(c) for c in columns])
