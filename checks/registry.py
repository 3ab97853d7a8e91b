"""One callable per operator: (spark, folder of the given tables) to a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from tidemark.functions.columns import insert_stamp
from tidemark.functions.literals import ts_literal
from tidemark.functions.surrogate import number_rows
from tidemark.functions.typing import conform
from tidemark.operators import (
    append_rows,
    apply_scd2,
    change_window,
    daily_from_state,
    daily_sales,
    daily_state,
    day_window,
    fact_sales_delta,
    impacted_dates,
    insert_absent,
    keyed_update,
    load_counts,
    matched_keys,
    merge_daily,
    open_versions,
    refresh_slices,
    upsert,
    within_key_range,
)
from tidemark.operators.sales import fact_sales
from tidemark.operators.scd2 import scd2_parts
from tidemark.plans import control as ctl
from tidemark.plans.runlog import latest_run, run_log_current
from tidemark.sources import (
    EventLog,
    PartitionedTable,
    own_path,
    read_csv,
    read_snapshot,
    save_bucketed,
    stage,
    upsert_bucketed,
    write_snapshot,
)

MONEY_OUT = ("quantity", "unit_price", "discount", "gross_amount", "net_sales_amount", "amount")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, once all arithmetic is done."""
    return df.withColumns({c: F.col(c).cast("double") for c in df.columns if c in MONEY_OUT})


def daily_out(df: DataFrame) -> DataFrame:
    types = {"total_revenue": "double", "total_items_sold": "double", "avg_order_value": "double"}
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def sales(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return fx.f_order_items(spark, sf_dir), fx.f_orders(spark, sf_dir)


def q_daily_sales(spark, sf_dir):
    return daily_out(daily_sales(*sales(spark, sf_dir)))


def q_window_either(spark, sf_dir):
    return change_window(fx.f_orders(spark, sf_dir), *fx.JANUARY, mode="either")


def q_window_both(spark, sf_dir):
    return change_window(fx.f_orders(spark, sf_dir), *fx.JANUARY, mode="both")


def q_impacted_dates(spark, sf_dir):
    return impacted_dates(*sales(spark, sf_dir), *fx.JANUARY)


def q_fact_sales_delta(spark, sf_dir):
    return plain(fact_sales_delta(*sales(spark, sf_dir), *fx.JANUARY))


def q_fact_sales_delta_orders(spark, sf_dir):
    """Changes of orders count as well, for all their items."""
    return plain(fact_sales_delta(*sales(spark, sf_dir), *fx.JANUARY, include_order_changes=True))


def q_fact_sales_day(spark, sf_dir):
    return plain(fact_sales_delta(*sales(spark, sf_dir), *day_window(*fx.DAY)))


def q_fact_sales_merge(spark, sf_dir):
    items, orders = sales(spark, sf_dir)
    first, loaded, last = fx.SALES_WINDOW
    target = fx.stored(fact_sales(items, orders), loaded, order_status=F.lit("?"))
    delta = fact_sales_delta(items, orders, first, last)
    # Both sides come out of a join by order, and all their rows are of these items.
    ordered = items.where(F.col("order_id").isNotNull())
    return plain(upsert(target, delta, ["order_item_id"], fx.LOAD, fx.AT, beside="order_id", among=ordered))


def q_daily_sales_refresh(spark, sf_dir):
    """The aggregate as of the day before, brought up to date for one more day of changes."""
    items, orders = sales(spark, sf_dir)
    window = day_window(*fx.DAY)
    before = daily_sales(items.where(F.col("create_dt") < ts_literal(window[0])), orders)
    target = fx.audited(before)
    dates = stage(impacted_dates(items, orders, *window), "impacted-dates")
    fresh = daily_sales(items, orders, dates).withColumns(insert_stamp(target, fx.LOAD, fx.AT))
    return daily_out(refresh_slices(target, fresh, dates, "order_date"))


def _upsert(
    view: Callable, keys: list[str], window: tuple[str, str, str], mode: str, plan: str = "auto", **as_it_was
) -> Callable:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        now = view(spark, sf_dir)
        first, loaded, last = window
        target = fx.stored(now, loaded, **{c: F.lit(v) for c, v in as_it_was.items()})
        return plain(upsert(target, change_window(now, first, last, mode), keys, fx.LOAD, fx.AT, plan=plan))

    return query


def q_bronze_upsert(spark, sf_dir):
    """The change set goes through a landing snapshot of text rows, typed on the way in."""
    now = fx.d_products(spark, sf_dir)
    first, loaded, last = fx.DIMENSION_WINDOW
    text = change_window(now, first, last, "either").select(*[F.col(c).cast("string") for c in now.columns])
    path = write_snapshot(text, own_path(spark, "landing-products"))
    typed, _ = conform(read_snapshot(spark, path), now.schema)
    target = fx.stored(now, loaded, name=F.lit("?"))
    return upsert(target, typed, ["product_id"], fx.LOAD, fx.AT)


def q_csv_landing_extract(spark, sf_dir):
    """All orders as a text extract, cut to the window, kept as a snapshot and read back typed."""
    orders = fx.f_orders(spark, sf_dir)
    csv = own_path(spark, "extract-orders")
    orders.write.option("header", True).csv(csv)
    changes = change_window(read_csv(spark, csv, orders.columns), *fx.JANUARY)
    path = write_snapshot(changes, own_path(spark, "landing-orders"))
    typed, _ = conform(read_snapshot(spark, path), orders.schema)
    return typed


def q_csv_ragged_lines(spark, sf_dir):
    """All orders as lines of text, of which some lack a field or have one too many: what is loaded and what is set aside.

    A rejected row keeps its whole line, from which its order is read here."""
    orders = fx.f_orders(spark, sf_dir)
    last = F.col("order_id") % 10
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in orders.columns]
    line = F.when(last == 3, F.concat_ws(",", *fields, F.lit("more"))).when(last == 7, F.concat_ws(",", *fields[:-1]))
    path = own_path(spark, "ragged-orders")
    orders.select(line.otherwise(F.concat_ws(",", *fields)).alias("line")).write.text(path)
    rows = read_csv(spark, path, orders.columns, ragged="line", header=False)
    first = lambda i: F.split("line", ",")[i]
    rejected = F.col("line").isNotNull()
    found = rows.select(
        F.when(rejected, "rejected").otherwise("loaded").alias("outcome"),
        F.when(rejected, first(3)).otherwise(F.col("order_status")).alias("order_status"),
        F.when(rejected, first(0)).otherwise(F.col("order_id")).cast("bigint").alias("order_id"),
    )
    return found.groupBy("outcome", "order_status").agg(F.count("*").alias("n"), F.sum("order_id").alias("sum_of_ids"))


def q_daily_sales_merged(spark, sf_dir):
    """The state of items shipped before 1995 merged with that of all later ones; many orders have items in both."""
    items, orders = sales(spark, sf_dir)
    early = F.col("create_dt") < fx.ntz("1995-01-01 00:00:00")
    parts = [daily_state(items.where(part), orders) for part in (early, ~early)]
    return daily_out(daily_from_state(*merge_daily(*parts)))


def q_daily_sales_refresh_partitions(spark, sf_dir):
    """As ``daily_sales_refresh``, where the aggregate has a folder per month and only touched ones are written."""
    items, orders = sales(spark, sf_dir)
    window = day_window(*fx.DAY)
    before = fx.audited(daily_sales(items.where(F.col("create_dt") < ts_literal(window[0])), orders))
    table = PartitionedTable(spark, own_path(spark, "daily-sales"), before.schema, "order_date", "month")
    table.create()
    table.replace(before, before.select("order_date"))
    dates = stage(impacted_dates(items, orders, *window), "impacted-dates")
    fresh = daily_sales(items, orders, dates).withColumns(insert_stamp(before, fx.LOAD, fx.AT))
    table.replace(fresh, dates)
    return daily_out(table.read())


def q_upsert_order_items_bucketed(spark, sf_dir):
    """The stored items lie in buckets of their key, so that only the changes are shuffled."""
    now, keys = fx.f_order_items(spark, sf_dir), ["order_item_id"]
    first, loaded, last = fx.SALES_WINDOW
    name = f"items_{uuid.uuid4().hex}"
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    save_bucketed(fx.stored(now, loaded, quantity=F.lit(0)), name, keys, buckets, own_path(spark, "bucketed"))
    changes = change_window(now, first, last, "both")
    return plain(upsert_bucketed(spark, name, changes, keys, fx.LOAD, fx.AT, f"{name}_next", own_path(spark, "bucketed")))


def q_upsert_order_items_ranged(spark, sf_dir):
    """The stored keys that match are looked for only between the smallest and the largest key of the changes."""
    now, keys = fx.f_order_items(spark, sf_dir), ["order_item_id"]
    first, loaded, last = fx.SALES_WINDOW
    target = stage(fx.stored(now, loaded, quantity=F.lit(0)), "items")
    changes = stage(change_window(now, first, last, "both"), "changes")
    matched = matched_keys(within_key_range(target, changes, keys), changes, keys)
    return plain(upsert(target, changes, keys, fx.LOAD, fx.AT, plan="split", matched=stage(matched, "matched")))


def _customers_after(spark, sf_dir, **options):
    source = change_window(fx.d_customers(spark, sf_dir), fx.DIMENSION_WINDOW[0], fx.DIMENSION_WINDOW[2], "both")
    target = fx.customer_versions(spark, sf_dir)
    return apply_scd2(target, source, ["customer_id"], fx.DIMENSION_WINDOW[2], fx.LOAD, fx.AT, **options)


def q_scd2_one_pass(spark, sf_dir):
    return _customers_after(spark, sf_dir, one_pass=True)


def q_scd2_current(spark, sf_dir):
    return open_versions(_customers_after(spark, sf_dir))


def q_insert_absent_products(spark, sf_dir):
    now = fx.d_products(spark, sf_dir)
    first, loaded, last = fx.DIMENSION_WINDOW
    known = now.where(F.col("create_dt") < fx.ntz(loaded)).withColumn("mdfctn_dt", F.col("create_dt"))
    # A product of the smallest size had its only version closed, so it counts as absent.
    ended = F.when(F.col("create_dt") < fx.ntz("1995-01-08 00:00:00"), fx.ntz("1995-01-09 00:00:00"))
    return insert_absent(
        fx.versioned(known, ended), change_window(now, first, last, "both"), ["product_id"], last, fx.LOAD, fx.AT
    )


def q_insert_absent_repeated(spark, sf_dir):
    """Keyed by brand and category, of which a source holds many rows: all of them are added, or none."""
    now = fx.d_products(spark, sf_dir)
    first, _, last = fx.DIMENSION_WINDOW
    known = now.where(F.col("create_dt") < fx.ntz(fx.FEW_KNOWN)).withColumn("mdfctn_dt", F.col("create_dt"))
    changes = change_window(now, first, last, "both")
    return insert_absent(fx.versioned(known), changes, ["brand", "category"], last, fx.LOAD, fx.AT)


def q_customer_surrogates(spark, sf_dir):
    """Per surrogate key after a load, how many versions carry it and whether this load added it."""
    source = change_window(fx.d_customers(spark, sf_dir), fx.DIMENSION_WINDOW[0], fx.DIMENSION_WINDOW[2], "both")
    target = stage(number_rows(stage(fx.customer_versions(spark, sf_dir), "versions"), "customer_sk", 0), "numbered")
    parts = scd2_parts(target, source, ["customer_id"], fx.DIMENSION_WINDOW[2], fx.LOAD, fx.AT, "customer_sk")
    last = target.agg(F.max("customer_sk")).collect()[0][0] or 0
    new = number_rows(stage(parts.appended, "new-customers"), "customer_sk", last)
    after = parts.closed.unionByName(parts.was_open).unionByName(new)
    added = F.max(F.col("dw_load_id") == fx.LOAD).alias("added")
    return after.groupBy("customer_sk").agg(F.count("*").alias("versions"), added)


def q_append_customers(spark, sf_dir):
    """Insert-select of all customers behind the versions stored so far."""
    target = fx.customer_versions(spark, sf_dir)
    stamp = insert_stamp(target, fx.LOAD, fx.AT, fx.DIMENSION_WINDOW[2])
    return append_rows(target, fx.d_customers(spark, sf_dir), **stamp)


def q_load_audit_counts(spark, sf_dir):
    return load_counts(QUERIES["upsert_orders"](spark, sf_dir), fx.LOAD, fx.AT)


def q_pending_tables(spark, sf_dir):
    return ctl.pending(fx.cntrl_stm_mapping(spark, sf_dir))


def q_pending_landing(spark, sf_dir):
    return ctl.pending_landing(fx.cntrl_stm_mapping(spark, sf_dir))


def q_unprocessed_tables(spark, sf_dir):
    return ctl.unprocessed_names(fx.cntrl_stm_mapping(spark, sf_dir))


def q_advance_window(spark, sf_dir):
    return ctl.advance_window(fx.cntrl_stm_mapping(spark, sf_dir), ["landing", "bronze"], fx.AT, fx.LOAD)


def q_advance_window_given(spark, sf_dir):
    control = fx.cntrl_stm_mapping(spark, sf_dir)
    return ctl.advance_window(control, ["silver", "gold"], fx.AT, fx.LOAD, *fx.JANUARY)


def q_mark_processed(spark, sf_dir):
    """Bronze tables whose window has ended by mid-February are marked, with their counts."""
    control = fx.cntrl_stm_mapping(spark, sf_dir)
    where = (F.col("target_layer_name") == "bronze") & (F.col("last_load_end_dt") <= fx.ntz("1996-02-15 00:00:00"))
    values = {
        "is_processed_flag": True,
        "source_count": 10,
        "target_count": 12,
        "dw_mdfctn_dt": ts_literal(fx.AT),
        "dw_load_id": fx.LOAD,
    }
    return keyed_update(control, where, values)


def q_load_range(spark, sf_dir):
    return ctl.load_range(fx.cntrl_stm_mapping(spark, sf_dir))


def q_run_outcome(spark, sf_dir):
    """One row per scope: the master run over all layers, and a run over landing as it stood once all
    its tables were marked."""
    control = fx.cntrl_stm_mapping(spark, sf_dir)
    landed = keyed_update(control, F.col("target_layer_name") == "landing", {"is_processed_flag": True})
    master = ctl.run_outcome(control).select(F.lit("master").alias("run"), "*")
    return master.unionByName(ctl.run_outcome(landed, ["landing"]).select(F.lit("landing").alias("run"), "*"))


def q_landing_file_pick(spark, sf_dir):
    return ctl.pick_files(fx.landing_file_list(spark, sf_dir), fx.cntrl_stm_mapping(spark, sf_dir))


def q_landing_file_register(spark, sf_dir):
    written = ctl.pending_landing(fx.cntrl_stm_mapping(spark, sf_dir)).select(
        F.col("bronze_table_id").alias("table_id"),
        F.concat_ws("/", F.lit("landing_files"), "source_table_name", F.col("last_load_end_dt").cast("date")).alias(
            "file_path"
        ),
        F.col("last_load_end_dt").alias("delta_load_dt"),
    )
    return ctl.register_files(fx.landing_file_list(spark, sf_dir), written, fx.AT, fx.LOAD)


def q_latest_run(spark, sf_dir):
    return latest_run(fx.run_headers(spark, sf_dir))


def q_run_header_append(spark, sf_dir):
    """A run is opened: one literal row behind all runs so far."""
    headers = fx.run_messages(spark, sf_dir)
    opened = [(-1, -1, ctl.STARTED, fx.AT, None, ctl.IN_PROGRESS)]
    return append_rows(headers, spark.createDataFrame(opened, headers.schema))


def q_run_close(spark, sf_dir):
    """The runs begun by mid-January that are still open end well."""
    headers = fx.run_messages(spark, sf_dir)
    where = (F.col("exec_status") == ctl.STARTED) & (F.col("wf_start_datetime") < fx.ntz("2024-01-15 00:00:00"))
    values = {"exec_status": ctl.SUCCESS, "status_message": ctl.RUN_DONE, "wf_end_datetime": ts_literal(fx.AT)}
    return keyed_update(headers, where, values)


def q_run_fail(spark, sf_dir):
    """The open runs of jobs up to number 40 are marked failed."""
    headers = fx.run_messages(spark, sf_dir)
    where = (F.col("exec_status") == ctl.STARTED) & (F.col("job_name") <= 40)
    values = {"exec_status": ctl.FAILED, "status_message": ctl.RUN_HAS_FAILURES, "wf_end_datetime": ts_literal(fx.AT)}
    return keyed_update(headers, where, values)


def q_landing_file_mark(spark, sf_dir):
    """The snapshots of some tables, by name, have been taken up."""
    registry = fx.landing_file_list(spark, sf_dir)
    return keyed_update(registry, F.col("table_name").startswith("brand_1"), {"is_processed_flag": True})


def q_run_log_current(spark, sf_dir):
    return run_log_current(fx.run_log(spark, sf_dir), ["task_name", "job_exec_dtl_id"], ["ts", "event_id"])


def q_run_log_appended(spark, sf_dir):
    """As ``run_log_current``, from a log to which every task appended its events in two parts, and one was put together."""
    events = stage(fx.run_log(spark, sf_dir), "run-events")
    log = EventLog(spark, own_path(spark, "run-log"), events.schema)
    tasks = [r[0] for r in events.select("task_name").distinct().orderBy("task_name").collect()]  # a handful
    for task in tasks:
        for odd in (0, 1):
            log.append(task, events.where((F.col("task_name") == task) & (F.pmod("event_id", F.lit(2)) == odd)))
    log.compact(tasks[0])
    return run_log_current(log.read(), ["task_name", "job_exec_dtl_id"], ["ts", "event_id"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "daily_sales": q_daily_sales,
    "window_either": q_window_either,
    "window_both": q_window_both,
    "impacted_dates": q_impacted_dates,
    "fact_sales_delta": q_fact_sales_delta,
    "fact_sales_delta_orders": q_fact_sales_delta_orders,
    "fact_sales_day": q_fact_sales_day,
    "fact_sales_merge": q_fact_sales_merge,
    "daily_sales_refresh": q_daily_sales_refresh,
    "bronze_upsert": q_bronze_upsert,
    "upsert_orders": _upsert(fx.f_orders, ["order_id"], fx.SALES_WINDOW, "both", order_status="?"),
    "upsert_orders_either": _upsert(fx.f_orders, ["order_id"], fx.SALES_WINDOW, "either", order_status="?"),
    "upsert_order_items": _upsert(fx.f_order_items, ["order_item_id"], fx.SALES_WINDOW, "both", quantity=0),
    "upsert_order_items_probe": _upsert(
        fx.f_order_items, ["order_item_id"], fx.SALES_WINDOW, "both", plan="probe", quantity=0
    ),
    "upsert_order_items_split": _upsert(
        fx.f_order_items, ["order_item_id"], fx.SALES_WINDOW, "both", plan="split", quantity=0
    ),
    "upsert_payments": _upsert(fx.f_payments, ["payment_id"], fx.SALES_WINDOW, "both", amount=0),
    "upsert_reviews": _upsert(fx.f_reviews, ["review_id"], fx.REVIEW_WINDOW, "both", rating=0),
    "upsert_shippings": _upsert(fx.f_shippings, fx.SHIPPING_KEYS, fx.SALES_WINDOW, "both", ship_status="?"),
    "upsert_categories": _upsert(
        fx.d_categories, ["category", "size_class"], fx.DIMENSION_WINDOW, "both", product_count=0
    ),
    "insert_absent_products": q_insert_absent_products,
    "insert_absent_repeated": q_insert_absent_repeated,
    "scd2_customers": _customers_after,
    "scd2_customers_one_pass": q_scd2_one_pass,
    "customer_surrogates": q_customer_surrogates,
    "scd2_current": q_scd2_current,
    "append_customers": q_append_customers,
    "load_audit_counts": q_load_audit_counts,
    "pending_tables": q_pending_tables,
    "pending_landing": q_pending_landing,
    "unprocessed_tables": q_unprocessed_tables,
    "advance_window": q_advance_window,
    "advance_window_given": q_advance_window_given,
    "mark_processed": q_mark_processed,
    "load_range": q_load_range,
    "run_outcome": q_run_outcome,
    "landing_file_pick": q_landing_file_pick,
    "landing_file_register": q_landing_file_register,
    "landing_file_mark": q_landing_file_mark,
    "run_header_append": q_run_header_append,
    "run_close": q_run_close,
    "run_fail": q_run_fail,
    "latest_run": q_latest_run,
    "run_log_current": q_run_log_current,
    "csv_landing_extract": q_csv_landing_extract,
    "run_log_appended": q_run_log_appended,
    "csv_ragged_lines": q_csv_ragged_lines,
    "daily_sales_merged": q_daily_sales_merged,
    "daily_sales_refresh_partitions": q_daily_sales_refresh_partitions,
    "upsert_order_items_bucketed": q_upsert_order_items_bucketed,
    "upsert_order_items_ranged": q_upsert_order_items_ranged,
}
