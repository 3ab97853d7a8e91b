"""Slowly changing dimension type 2: close the version that changed, open the next one.

Closed versions are never joined, and a closed version never changes again, so a load may keep
them in place and write only ``expired`` and ``appended`` next to what stays open.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.columns import business_columns, insert_stamp, split_on_keys
from tidemark.functions.literals import ts_literal

_LOW, _HIGH = "__low", "__high"
_NEW, _CLOSED, _STAYS = "__new", "__closed", "__stays"


def open_versions(df: DataFrame) -> DataFrame:
    return df.where(F.col("dw_eff_end_dt").isNull())


def conflicting_changes(target: DataFrame, source: DataFrame, keys: Sequence[str], modified: str = "mdfctn_dt") -> DataFrame:
    """Keys with an open version that more than one source row would close, and how many rows do.

    Only rows that differ from the open version close it; a NULL on either side is no change. Rows that
    repeat a key without a change are no conflict.
    """
    opened = open_versions(target).select(*keys, F.col(modified).alias("__stored"))
    incoming = source.select(*keys, F.col(modified).cast(target.schema[modified].dataType).alias("__given"))
    known, _ = split_on_keys(opened, keys)
    fresh, _ = split_on_keys(incoming, keys)
    # Reduced to the repeated keys first, which are few or none.
    repeated = fresh.groupBy(*keys).agg(F.count("__given").alias("n")).where("n > 1").select(*keys)
    times = fresh.join(repeated, list(keys), "left_semi").groupBy(*keys, "__given").agg(F.count("*").alias("source_rows"))
    changing = times.join(known.distinct(), list(keys)).where("__given <> __stored")
    changing = changing.groupBy(*keys, "__stored").agg(F.sum("source_rows").alias("source_rows"))
    return changing.where("source_rows > 1").select(*keys, "source_rows")


@dataclass(frozen=True)
class Scd2Parts:
    closed: DataFrame
    """Versions that were closed before; untouched."""
    was_open: DataFrame
    """Versions that were open: still open, or closed by this load."""
    appended: DataFrame
    """New open versions, without the surrogate key."""


def scd2_parts(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    eff_ts: datetime,
    load_id: str,
    load_ts: datetime,
    surrogate: str | None = None,
    modified: str = "mdfctn_dt",
) -> Scd2Parts:
    """The next state in three parts.

    An open version is closed at ``eff_ts`` when a source row of its key has another modification
    time (a NULL on either side is no change). A source row is appended, effective from the same
    instant, when its key has no version left open; NULL keys match nothing and are appended.
    """
    types = {f.name: f.dataType for f in target.schema.fields}
    columns = [c for c in target.columns if c != surrogate]
    incoming = source.select(*[F.col(c).cast(types[c]).alias(c) for c in business_columns(target, surrogate)])
    fresh, unkeyed_new = split_on_keys(incoming, keys)
    known, unkeyed_old = split_on_keys(open_versions(target), keys)

    # One narrow row per key. "Some source row differs" is "the lowest or the highest differs".
    seen = fresh.groupBy(*keys).agg(F.min(modified).alias(_LOW), F.max(modified).alias(_HIGH))
    changed = F.coalesce(F.col(modified) != F.col(_LOW), F.lit(False)) | F.coalesce(
        F.col(modified) != F.col(_HIGH), F.lit(False)
    )

    closing = {
        "dw_eff_end_dt": ts_literal(eff_ts, types["dw_eff_end_dt"]),
        "dw_mdfctn_dt": ts_literal(load_ts, types["dw_mdfctn_dt"]),
        "dw_update_id": F.lit(load_id).cast(types["dw_update_id"]),
    }
    was_open = known.join(seen, list(keys), "left_outer").select(
        *[F.when(changed, closing[c]).otherwise(F.col(c)).alias(c) if c in closing else F.col(c) for c in target.columns]
    )
    if unkeyed_old is not None:
        was_open = was_open.unionByName(unkeyed_old)

    stays_open = known.select(*keys, modified).join(seen, list(keys), "inner").where(~changed).select(*keys)
    appended = fresh.join(stays_open, list(keys), "left_anti")
    if unkeyed_new is not None:
        appended = appended.unionByName(unkeyed_new)
    stamp = insert_stamp(target, load_id, load_ts, eff_ts)
    appended = appended.select(*[stamp[c].alias(c) if c in stamp else F.col(c) for c in columns])
    return Scd2Parts(target.where(F.col("dw_eff_end_dt").isNotNull()), was_open, appended)


def apply_scd2(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    eff_ts: datetime,
    load_id: str,
    load_ts: datetime,
    surrogate: str | None = None,
    modified: str = "mdfctn_dt",
    one_pass: bool = False,
) -> DataFrame:
    """The whole next state. With ``surrogate``, appended rows carry NULL there until they are numbered.

    ``one_pass`` shuffles open versions and source once each, together, in place of joining them twice. All
    rows of a key then meet in one task, so it is for sources that do not repeat a key very many times.
    The result is the same.
    """
    if one_pass:
        return _in_one_pass(target, source, keys, eff_ts, load_id, load_ts, surrogate, modified)
    parts = scd2_parts(target, source, keys, eff_ts, load_id, load_ts, surrogate, modified)
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=surrogate is not None),
        [parts.closed, parts.was_open, parts.appended],
    )


def _in_one_pass(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    eff_ts: datetime,
    load_id: str,
    load_ts: datetime,
    surrogate: str | None,
    modified: str,
) -> DataFrame:
    """Open versions and source rows in one frame, told apart by a mark and judged per key."""
    types = {f.name: f.dataType for f in target.schema.fields}
    given = set(business_columns(target, surrogate))
    stamp = insert_stamp(target, load_id, load_ts, eff_ts)
    none = {c: F.lit(None).cast(types[c]) for c in target.columns}
    new = source.select(*[(F.col(c).cast(types[c]) if c in given else stamp.get(c, none[c])).alias(c) for c in target.columns])
    fresh, unkeyed_new = split_on_keys(new, keys)
    known, unkeyed_old = split_on_keys(open_versions(target), keys)

    both = known.withColumn(_NEW, F.lit(False)).unionByName(fresh.withColumn(_NEW, F.lit(True)))
    of_key = W.partitionBy(*keys)
    seen = F.when(F.col(_NEW), F.col(modified))
    both = both.withColumns({_LOW: F.min(seen).over(of_key), _HIGH: F.max(seen).over(of_key)})
    differs = [F.coalesce(F.col(modified) != F.col(c), F.lit(False)) for c in (_LOW, _HIGH)]
    closed = ~F.col(_NEW) & (differs[0] | differs[1])
    # Whether the key has a version that stays open; then its source rows add nothing.
    both = both.withColumn(_CLOSED, closed).withColumn(_STAYS, F.max(~F.col(_NEW) & ~F.col(_CLOSED)).over(of_key))
    closing = {
        "dw_eff_end_dt": ts_literal(eff_ts, types["dw_eff_end_dt"]),
        "dw_mdfctn_dt": ts_literal(load_ts, types["dw_mdfctn_dt"]),
        "dw_update_id": F.lit(load_id).cast(types["dw_update_id"]),
    }
    state = both.where(~(F.col(_NEW) & F.col(_STAYS))).select(
        *[F.when(F.col(_CLOSED), closing[c]).otherwise(F.col(c)).alias(c) if c in closing else F.col(c) for c in target.columns]
    )
    untouched = target.where(F.col("dw_eff_end_dt").isNotNull())
    return reduce(DataFrame.unionByName, [x for x in (untouched, state, unkeyed_old, unkeyed_new) if x is not None])
