"""The sales mart: fact rows, daily totals, and the days a change touches."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tidemark.functions.literals import closed_range, whole_days
from tidemark.functions.sizes import below_broadcast_threshold
from tidemark.operators.windows import in_window


def fact_sales_delta(
    items: DataFrame,
    orders: DataFrame,
    start: datetime | str,
    end: datetime | str,
    include_order_changes: bool = False,
) -> DataFrame:
    """Fact rows of the order items that changed in the window; items without an order drop out.

    A change of the order alone is not picked up unless ``include_order_changes``.
    """
    changed = in_window(items, start, end, "either")
    facts = fact_sales(items.where(changed), orders)
    if include_order_changes:
        # The other items of changed orders, so each row comes from exactly one branch.
        moved = closed_range("mdfctn_dt", orders.schema["mdfctn_dt"].dataType, start, end)
        rest = items.where(~F.coalesce(changed, F.lit(False)))
        facts = facts.unionByName(fact_sales(rest, orders.where(moved)))
    return facts


def fact_sales(items: DataFrame, orders: DataFrame) -> DataFrame:
    header = orders.select("order_id", "customer_id", "order_date", "order_status")
    gross = F.col("quantity") * F.col("unit_price")
    return items.join(header, "order_id", "inner").select(
        "order_item_id",
        "order_id",
        "product_id",
        "customer_id",
        "order_date",
        "order_status",
        "quantity",
        "unit_price",
        F.round(gross, 2).alias("gross_amount"),
        "discount",
        F.round(gross - F.col("discount"), 2).alias("net_sales_amount"),
        "create_dt",
        "mdfctn_dt",
    )


def impacted_dates(items: DataFrame, orders: DataFrame, start: datetime | str, end: datetime | str) -> DataFrame:
    """Order dates with an item created or modified, or an order modified, on a day of the window.

    Read as two joins, each with one side already cut to the changes, instead of one join of both
    whole tables with an OR across them: the cut reaches the scan and the small side can be probed.
    Orders without a date are left out.
    """
    item_types = {f.name: f.dataType for f in items.schema.fields}
    changed_items = items.where(
        whole_days("create_dt", item_types["create_dt"], start, end)
        | whole_days("mdfctn_dt", item_types["mdfctn_dt"], start, end)
    )
    dated = orders.where(F.col("order_date").isNotNull())
    changed_orders = dated.where(whole_days("mdfctn_dt", orders.schema["mdfctn_dt"].dataType, start, end))

    by_item = dated.select("order_id", "order_date").join(
        changed_items.select("order_id").distinct(), "order_id", "left_semi"
    )
    by_order = items.select("order_id").join(changed_orders.select("order_id", "order_date"), "order_id", "inner")
    return by_item.select("order_date").unionByName(by_order.select("order_date")).distinct()


def daily_sales(items: DataFrame, orders: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Five measures per order date, over all dates or only those in ``dates(order_date)``.

    Items become one row per order before the two exact distinct counts, which then expand rows per
    order and not per item. Over all dates, or where the orders in scope are many, items are summed
    per order ahead of the join: the sum is combined before its shuffle, so an order with very many
    items arrives as one row per task, and the join reuses that shuffle. Where the orders in scope
    are small enough to broadcast, items are probed against them first and the rest never shuffle.
    """
    totals = per_order(items, orders, dates).groupBy("order_date").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.count_distinct("customer_id").alias("total_customers"),
        F.sum("net").alias("revenue"),
        F.sum("quantity").alias("total_items_sold"),
    )
    return totals.select(
        "order_date",
        "total_orders",
        "total_customers",
        F.round("revenue", 2).alias("total_revenue"),
        "total_items_sold",
        average_order_value(totals, "revenue", "total_orders").alias("avg_order_value"),
    )


def per_order(items: DataFrame, orders: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """(order_id, customer_id, order_date, net, quantity): the items of each order, summed."""
    header = orders.select("order_id", "customer_id", "order_date")
    net = F.col("quantity") * F.col("unit_price") - F.col("discount")
    lines = items.select("order_id", "quantity", net.alias("net"))
    sums = [F.sum("net").alias("net"), F.sum("quantity").alias("quantity")]
    if dates is not None:
        header = header.join(dates.select("order_date"), "order_date", "left_semi")
    if dates is not None and below_broadcast_threshold(header):
        return lines.join(header, "order_id", "inner").groupBy("order_date", "order_id", "customer_id").agg(*sums)
    return lines.groupBy("order_id").agg(*sums).join(header, "order_id", "inner")


def average_order_value(totals: DataFrame, revenue: str, orders: str) -> Column:
    return F.round(_exact_quotient(totals, revenue, orders), 2)


def _exact_quotient(df: DataFrame, total: str, count: str) -> Column:
    """total / count with enough digits that rounding it to cents rounds once.

    Spark cuts the quotient of a wide sum and a bigint to 6 digits. Narrower operands leave 15, which
    tells a half cent from any other value of up to 10^11 orders. What does not fit is an error, not NULL.
    """
    kind = df.schema[total].dataType
    if not isinstance(kind, DecimalType):
        return F.col(total) / F.col(count)

    def narrowed(name: str, type_name: str) -> Column:
        small = F.col(name).try_cast(type_name)
        too_large = F.raise_error(F.lit(f"{name} does not fit {type_name}")).cast(type_name)
        return F.when(small.isNull() & F.col(name).isNotNull(), too_large).otherwise(small)

    return narrowed(total, f"decimal(27,{kind.scale})") / narrowed(count, "decimal(11,0)")
