"""Column updates by predicate or by key, and appends."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import split_on_keys


def keyed_update(df: DataFrame, where: Column, values: Mapping[str, object]) -> DataFrame:
    """Set columns where the predicate holds; a NULL predicate does not hold.

    All new values are computed from the old row, in one projection.
    """
    hit = F.coalesce(where, F.lit(False))
    types = {f.name: f.dataType for f in df.schema.fields}

    def value(name: str) -> Column:
        new = values[name]
        new = new if isinstance(new, Column) else F.lit(new)
        return F.when(hit, new.cast(types[name])).otherwise(F.col(name)).alias(name)

    return df.select(*[value(c) if c in values else F.col(c) for c in df.columns])


def update_from(target: DataFrame, updates: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Set ``columns`` from the update row with the same key (at most one per key); never insert."""
    types = {f.name: f.dataType for f in target.schema.fields}
    given = updates.select(*keys, *[F.col(c).alias("__new_" + c) for c in columns], F.lit(True).alias("__hit"))
    known, unkeyed = split_on_keys(target, keys)
    out = known.join(given, list(keys), "left_outer").select(
        *[
            F.when(F.col("__hit").isNotNull(), F.col("__new_" + c).cast(types[c])).otherwise(F.col(c)).alias(c)
            if c in columns
            else F.col(c)
            for c in target.columns
        ]
    )
    return out if unkeyed is None else out.unionByName(unkeyed)


def append_rows(target: DataFrame, rows: DataFrame, **literals: Column) -> DataFrame:
    """Insert-select: match columns by name, fill the named literals, NULL where nothing is given."""
    types = {f.name: f.dataType for f in target.schema.fields}

    def value(name: str) -> Column:
        if name in literals:
            return literals[name].cast(types[name]).alias(name)
        if name in rows.columns:
            return F.col(name).cast(types[name]).alias(name)
        return F.lit(None).cast(types[name]).alias(name)

    return target.unionByName(rows.select(*[value(c) for c in target.columns]))
