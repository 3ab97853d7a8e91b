"""Exact distinct counts as a state that can be merged: bitmaps, a row per group and bucket of ids.

A distinct count of two parts is not the sum of theirs, so without a state every change of a group means
reading all its rows again. Bitmaps of whole-number ids are added up with a bitwise or. A bucket covers
32,768 neighbouring ids in 4 KB, before compression. That is little for ids that are handed out in order, as
keys of orders and customers are; for ids spread over all 64 bits a state costs more than the rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tidemark.operators.sales import average_order_value, per_order

GROUP, WHAT, BUCKET, BITS = "order_date", "measure", "bucket", "bits"


def distinct_state(df: DataFrame, group: str, ids: Mapping[str, str]) -> DataFrame:
    """(group, measure, bucket, bits): which ids each measure has seen. ``ids`` names a column per measure.

    Ids are whole numbers, also negative ones; NULL ids are not counted. Rows combine before their shuffle.
    """
    wrong = [c for c in ids.values() if not isinstance(df.schema[c].dataType, IntegralType)]
    if wrong:
        raise ValueError(f"{wrong[0]} must hold whole numbers")
    seen = F.explode(F.array(*[F.struct(F.lit(m).alias(WHAT), F.col(c).cast("bigint").alias("id")) for m, c in ids.items()]))
    rows = df.select(group, seen.alias("seen")).select(group, f"seen.{WHAT}", "seen.id").where("id is not null")
    bucket = F.bitmap_bucket_number("id").alias(BUCKET)
    return rows.groupBy(group, WHAT, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias(BITS))


def merge_states(*states: DataFrame) -> DataFrame:
    """One state of all; an id seen by several counts once."""
    whole = reduce(DataFrame.unionByName, states)
    keys = [c for c in whole.columns if c != BITS]
    return whole.groupBy(*keys).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_counts(state: DataFrame, measures: Mapping[str, str] | list[str]) -> DataFrame:
    """(group, one column per measure): 0 where a measure of a known group has seen no id."""
    group = next(c for c in state.columns if c not in (WHAT, BUCKET, BITS))
    n = F.bitmap_count(BITS)
    counts: list[Column] = [F.coalesce(F.sum(F.when(F.col(WHAT) == m, n)), F.lit(0)).alias(m) for m in measures]
    return state.groupBy(group).agg(*counts)


MEASURES = {"total_orders": "order_id", "total_customers": "customer_id"}


def daily_state(items: DataFrame, orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What ``daily_sales`` needs to know of some items: (distinct state, sums per date).

    Items may be split in any way into parts, say by arrival; the orders are those of the items. An order
    whose items lie in several parts is counted once when they are merged.
    """
    lines = per_order(items, orders)
    sums = lines.groupBy(GROUP).agg(F.sum("net").alias("revenue"), F.sum("quantity").alias("quantity"))
    return distinct_state(lines, GROUP, MEASURES), sums


def merge_daily(*parts: tuple[DataFrame, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """The state of all parts together, for instance of what was stored and what is new."""
    sums = reduce(DataFrame.unionByName, [s for _, s in parts])
    added = sums.groupBy(GROUP).agg(*[F.sum(c).cast(sums.schema[c].dataType).alias(c) for c in ("revenue", "quantity")])
    return merge_states(*[s for s, _ in parts]), added


def daily_from_state(state: DataFrame, sums: DataFrame) -> DataFrame:
    """The columns of ``daily_sales``, without reading items or orders."""
    # A NULL date is a group as well.
    counts = distinct_counts(state, list(MEASURES)).withColumnRenamed(GROUP, "__date")
    totals = sums.join(counts, F.col(GROUP).eqNullSafe(F.col("__date")), "left")
    totals = totals.withColumns({m: F.coalesce(m, F.lit(0)) for m in MEASURES})
    return totals.select(
        GROUP,
        "total_orders",
        "total_customers",
        F.round("revenue", 2).alias("total_revenue"),
        F.col("quantity").alias("total_items_sold"),
        average_order_value(totals, "revenue", "total_orders").alias("avg_order_value"),
    )
