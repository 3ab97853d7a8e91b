from __future__ import annotations

from collections import Counter
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.frames import LOAD_AT, NEW, OLD, D, rows
from tidemark.functions import insert_stamp
from tidemark.operators import daily_sales, drop_slices, fact_sales_delta, load_counts, refresh_slices

ITEMS = (
    "order_item_id string, order_id bigint, product_id bigint, quantity decimal(12,2), unit_price decimal(12,2), "
    "discount decimal(12,2), create_dt timestamp_ntz, mdfctn_dt timestamp_ntz"
)
ORDERS = (
    "order_id bigint, customer_id bigint, order_date date, order_status string, create_dt timestamp_ntz, "
    "mdfctn_dt timestamp_ntz"
)
OLD_T, NEW_T = D("2024-01-01"), D("2024-02-01")
JAN1, JAN2 = date(2024, 1, 1), date(2024, 1, 2)


def item(item_id, order_id, quantity, price, discount, created=OLD_T, modified=OLD_T):
    money = [None if x is None else Decimal(str(x)) for x in (quantity, price, discount)]
    return (item_id, order_id, 7, *money, created, modified)


def frames(spark):
    items = [
        item("a", 1, 2, "10.00", "0.01"),
        item("b", 1, 1, "5.00", None),
        item("c", 2, 1, "0.02", "0.00"),
        item("d", 3, 1, "1.00", "0.00"),
        item("e", 9, 1, "1.00", "0.00"),
        item("f", 4, 3, "2.00", "0.50", modified=NEW_T),
    ]
    orders = [
        (1, 100, JAN1, "O", OLD_T, OLD_T),
        (2, 100, JAN1, "O", OLD_T, OLD_T),
        (3, 101, None, "O", OLD_T, OLD_T),
        (4, 102, JAN2, "F", OLD_T, NEW_T),
        (5, 103, JAN2, "F", OLD_T, NEW_T),
    ]
    return spark.createDataFrame(items, ITEMS), spark.createDataFrame(orders, ORDERS)


def test_daily_sales(spark):
    got = {r.order_date: tuple(r)[1:] for r in daily_sales(*frames(spark)).collect()}
    cents = Decimal
    # 19.99 + NULL and 0.02: 20.01 over two orders is 10.005, which goes up. Order 5 has no item,
    # item "e" no order.
    assert got[JAN1] == (2, 1, cents("20.01"), cents("4.00"), cents("10.01"))
    assert got[JAN2] == (1, 1, cents("5.50"), cents("3.00"), cents("5.50"))
    assert got[None] == (1, 1, cents("1.00"), cents("1.00"), cents("1.00"))
    assert len(got) == 3


def test_daily_sales_of_some_dates_is_the_same_in_both_shapes(spark):
    items, orders = frames(spark)
    dates = spark.createDataFrame([(JAN1,)], "order_date date")
    want = rows(daily_sales(items, orders).where(F.col("order_date") == JAN1))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold in ("10MB", "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            assert rows(daily_sales(items, orders, dates)) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_one_order_with_very_many_items_is_combined_before_the_shuffle(spark):
    plan = daily_sales(*frames(spark))._jdf.queryExecution().executedPlan().toString()
    below_join = plan[plan.index("Join") :]
    assert below_join.index("partial_sum") > below_join.index("hashpartitioning(order_id")


def test_a_third_of_all_items_in_one_order_and_one_customer(spark):
    """Checked against plain Python sums."""
    owner = {order: 0 if order % 3 == 0 else order % 7 for order in range(60)}
    lines = [(0 if n % 3 == 0 else n % 60, n % 5 + 1, n % 11, n % 3) for n in range(3000)]
    items = spark.createDataFrame(
        [item(str(n), o, q, f"{p}.25", f"0.0{d}") for n, (o, q, p, d) in enumerate(lines)], ITEMS
    )
    orders = spark.createDataFrame(
        [(o, c, date(2024, 1, 1 + o % 4), "O", OLD_T, OLD_T) for o, c in owner.items()], ORDERS
    )
    want = {}
    for o, q, p, d in lines:
        day = want.setdefault(date(2024, 1, 1 + o % 4), [set(), set(), Decimal(0), 0])
        day[0].add(o)
        day[1].add(owner[o])
        day[2] += q * Decimal(f"{p}.25") - Decimal(f"0.0{d}")
        day[3] += q
    got = {r.order_date: r for r in daily_sales(items, orders).collect()}
    assert {d: (len(v[0]), len(v[1]), v[2], v[3]) for d, v in want.items()} == {
        d: (r.total_orders, r.total_customers, r.total_revenue, r.total_items_sold) for d, r in got.items()
    }


def test_fact_rows_follow_item_changes_and_on_request_order_changes(spark):
    items, orders = frames(spark)
    delta = fact_sales_delta(items, orders, "2024-01-31", "2024-02-02").collect()
    assert [(r.order_item_id, r.gross_amount, r.net_sales_amount) for r in delta] == [
        ("f", Decimal("6.00"), Decimal("5.50"))
    ]
    moved = orders.withColumn("mdfctn_dt", F.when(F.col("order_id") == 1, F.lit(NEW_T)).otherwise(F.col("mdfctn_dt")))
    wide = fact_sales_delta(items, moved, "2024-01-31", "2024-02-02", include_order_changes=True)
    assert Counter(r.order_item_id for r in wide.collect()) == Counter("abf")


SLICES = "day date, n bigint"


def test_refresh_replaces_whole_slices_and_leaves_others(spark):
    target = spark.createDataFrame([(JAN1, 1), (JAN1, 2), (JAN2, 3), (None, 4)], SLICES)
    fresh = spark.createDataFrame([(9, JAN1)], "n bigint, day date")
    touched = spark.createDataFrame([(JAN1,)], "day date")
    assert rows(refresh_slices(target, fresh, touched, "day")) == Counter([(JAN1, 9), (JAN2, 3), (None, 4)])
    assert rows(drop_slices(target, touched, "day")) == Counter([(JAN2, 3), (None, 4)])


def test_refresh_equals_full_recompute_on_touched_dates(spark):
    items, orders = frames(spark)
    target = daily_sales(items, orders).withColumn("total_orders", F.lit(0).cast("bigint"))
    touched = spark.createDataFrame([(JAN2,)], "order_date date")
    after = refresh_slices(target, daily_sales(items, orders, touched), touched, "order_date")
    full = daily_sales(items, orders)
    at = F.col("order_date") == JAN2
    assert rows(after.where(at)) == rows(full.where(at))
    assert rows(after.where(F.coalesce(~at, F.lit(True)))) == rows(target.where(F.coalesce(~at, F.lit(True))))


def test_load_counts(spark):
    schema = "id bigint, dw_create_dt timestamp_ntz, dw_mdfctn_dt timestamp_ntz, dw_load_id string, dw_update_id string"
    same_day = (OLD[0], D("2024-02-01 23:00:00"), "L0", "L0b")
    df = spark.createDataFrame(
        [(1, *OLD), (2, *NEW), (3, OLD[0], LOAD_AT, "L0", "L1"), (4, *same_day), (5, None, None, None, None)], schema
    )
    assert rows(load_counts(df, "L1", LOAD_AT)) == Counter([(3, 1, 1, 2)])
    assert rows(load_counts(df.limit(0), "L1", LOAD_AT)) == Counter([(0, 0, 0, 0)])


def test_stamp_takes_the_types_of_the_target(spark):
    df = spark.createDataFrame(
        [], "dw_create_dt timestamp, dw_mdfctn_dt timestamp, dw_load_id bigint, dw_update_id bigint"
    )
    stamped = spark.range(1).select(*[v.alias(k) for k, v in insert_stamp(df, "5", LOAD_AT).items()])
    assert [f.dataType for f in stamped.schema] == [f.dataType for f in df.schema]


def test_an_average_is_rounded_once_however_many_orders(spark):
    """25,000.12 over 200,001 orders is just below an eighth."""
    orders = spark.range(200_001).select(
        F.col("id").alias("order_id"), F.lit(1).cast("bigint").alias("customer_id"), F.lit(JAN1).alias("order_date")
    )
    price = F.when(F.col("id") == 0, F.lit("25000.12")).otherwise(F.lit("0")).cast("decimal(12,2)")
    items = spark.range(200_001).select(
        F.col("id").alias("order_id"),
        F.lit("1").cast("decimal(12,2)").alias("quantity"),
        price.alias("unit_price"),
        F.lit("0").cast("decimal(12,2)").alias("discount"),
    )
    (row,) = daily_sales(items, orders).collect()
    assert (row.total_orders, row.total_revenue, row.avg_order_value) == (200_001, Decimal("25000.12"), Decimal("0.12"))


def test_a_revenue_that_does_not_fit_is_an_error(spark):
    one = spark.range(1)
    orders = one.select(F.lit(1).alias("order_id"), F.lit(1).alias("customer_id"), F.lit(JAN1).alias("order_date"))
    huge = F.lit("1" * 30).cast("decimal(38,0)")
    items = one.select(F.lit(1).alias("order_id"), huge.alias("quantity"), F.lit(1).cast("decimal(1,0)").alias("unit_price"), F.lit(0).cast("decimal(1,0)").alias("discount"))
    with pytest.raises(Exception, match="does not fit"):
        daily_sales(items, orders).collect()


def test_the_filter_of_load_counts_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "audited")
    spark.range(10).select(
        F.lit(D("2024-01-05")).cast("timestamp_ntz").alias("dw_mdfctn_dt"), F.lit("L1").alias("dw_load_id"), F.lit(None).cast("string").alias("dw_update_id")
    ).write.parquet(path)
    plan = load_counts(spark.read.parquet(path), "L1", LOAD_AT)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan
