"""The given tables in the shape the operators expect, as Spark frames.

``checks.oracle`` states the same views in SQL. Every view is made of whole tables; what a load has
already stored and what it now reads are told apart by time, as in a real load.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# When the state in the targets was loaded, and the load under test.
FIRST_LOAD, FIRST_AT = "L0", datetime(2024, 1, 1, 6, 0, 0)
LOAD, AT = "L1", datetime(2024, 2, 1, 6, 0, 0)

# Per table: the first instant of the change window, the instant up to which the target had been
# loaded (later than that, so the window delivers some rows again), and the window's last instant.
SALES_WINDOW = ("1997-01-01 00:00:00", "1999-01-01 00:00:00", "2001-06-30 23:59:59")
DIMENSION_WINDOW = ("1995-01-06 00:00:00", "1995-01-12 00:00:00", "1995-02-15 23:59:59")
REVIEW_WINDOW = ("2024-01-08 00:00:00", "2024-01-20 00:00:00", "2024-01-28 23:59:59")
FEW_KNOWN = "1995-01-03 00:00:00"  # by then only some brands and categories had a product
JANUARY = ("1996-01-01 00:00:00", "1996-01-31 23:59:59")
DAY = (1996, 1, 15)

MONEY = "decimal(12,2)"


def days(count: Column | str) -> Column:
    return F.make_dt_interval(F.col(count).cast("int") if isinstance(count, str) else count.cast("int"))


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def f_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("create_dt"),
        (F.col("o_orderdate") + days(F.col("o_orderkey") % 30)).alias("mdfctn_dt"),
    )


def f_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    item_id = F.concat_ws(
        "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_shipdate").cast("date").cast("string")
    )
    return given(spark, sf_dir, "lineitem").select(
        item_id.alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast(MONEY).alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("unit_price"),
        F.col("l_discount").cast(MONEY).alias("discount"),
        F.col("l_shipdate").alias("create_dt"),
        (F.col("l_shipdate") + days("l_linenumber")).alias("mdfctn_dt"),
    )


def f_shippings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_shipdate").alias("shipped_dt"),
        F.col("l_linestatus").alias("ship_status"),
        F.col("l_shipdate").alias("create_dt"),
        (F.col("l_shipdate") + days("l_linenumber")).alias("mdfctn_dt"),
    )


SHIPPING_KEYS = ["order_id", "line_number", "product_id", "supplier_id", "shipped_dt"]


def f_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("payment_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_totalprice").cast(MONEY).alias("amount"),
        F.col("o_orderdate").alias("create_dt"),
        (F.col("o_orderdate") + days(F.col("o_orderkey") % 30)).alias("mdfctn_dt"),
    )


def f_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "events").select(
        F.col("event_id").alias("review_id"),
        F.col("user_id").alias("customer_id"),
        F.col("event_type").alias("topic"),
        F.col("value").alias("rating"),
        F.col("ts").alias("create_dt"),
        (F.col("ts") + days(F.col("event_id") % 5)).alias("mdfctn_dt"),
    )


def d_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    created = ntz("1995-01-01 00:00:00") + days("c_nationkey")
    return given(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
        created.alias("create_dt"),
        (created + days(F.col("c_custkey") % 30)).alias("mdfctn_dt"),
    )


def d_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    created = ntz("1995-01-01 00:00:00") + days("p_size")
    return given(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
        created.alias("create_dt"),
        (created + days(F.col("p_partkey") % 30)).alias("mdfctn_dt"),
    )


def d_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One category per type and size of part, with a composite key."""
    created = ntz("1995-01-01 00:00:00") + days("p_size")
    return (
        given(spark, sf_dir, "part")
        .groupBy("p_type", "p_size")
        .agg(F.count("*").alias("product_count"), (F.min("p_partkey") % 30).alias("__age"))
        .select(
            F.col("p_type").alias("category"),
            F.col("p_size").alias("size_class"),
            "product_count",
            created.alias("create_dt"),
            (created + days("__age")).alias("mdfctn_dt"),
        )
    )


# What the targets held before the load under test.


def stored(view: DataFrame, loaded_up_to: str, **as_it_was: Column) -> DataFrame:
    """Rows created before ``loaded_up_to``, as first loaded: unmodified, with some values since replaced."""
    first = view.where(F.col("create_dt") < ntz(loaded_up_to)).withColumns(
        {"mdfctn_dt": F.col("create_dt"), **{c: v.cast(view.schema[c].dataType) for c, v in as_it_was.items()}}
    )
    return audited(first)


def audited(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "dw_create_dt": ntz(str(FIRST_AT)),
            "dw_mdfctn_dt": ntz(str(FIRST_AT)),
            "dw_load_id": F.lit(FIRST_LOAD),
            "dw_update_id": F.lit(None).cast("string"),
        }
    )


def versioned(df: DataFrame, eff_end: Column | None = None) -> DataFrame:
    return audited(df).withColumns(
        {
            "dw_eff_start_dt": ntz("1995-01-01 00:00:00"),
            "dw_eff_end_dt": F.lit(None).cast("timestamp_ntz") if eff_end is None else eff_end,
        }
    )


def customer_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions stored so far, by segment: MACHINERY customers are not known yet, FURNITURE customers
    have only a closed version, HOUSEHOLD customers a closed and an open one, AUTOMOBILE customers are
    already stored as they are now, the rest as they were created. A customer in debt has no
    modification time on the open version."""
    now = d_customers(spark, sf_dir)
    segment = F.col("segment")
    stored_at = F.when(segment == "AUTOMOBILE", F.col("mdfctn_dt")).otherwise(F.col("create_dt"))
    stored_at = F.when(F.col("balance") < 0, F.lit(None).cast("timestamp_ntz")).otherwise(stored_at)
    opened = now.where(~segment.isin("MACHINERY", "FURNITURE")).withColumn("mdfctn_dt", stored_at)
    ended = now.where(segment.isin("HOUSEHOLD", "FURNITURE")).withColumn("mdfctn_dt", F.col("create_dt"))
    return versioned(opened).unionByName(versioned(ended, ntz("1995-01-02 00:00:00")))


# Control tables: one governed table per brand and type of part, counted and dated from all its parts.


def product_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat_ws("_", F.lower(F.regexp_replace("p_brand", "#", "_")), F.lower("p_type"))
    return (
        given(spark, sf_dir, "part")
        .groupBy(line.alias("line"))
        .agg(
            F.count("*").alias("n"),
            F.min("p_partkey").alias("first_part"),
            F.min("p_size").alias("low"),
            F.max("p_size").alias("high"),
        )
    )


def cntrl_stm_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = ntz("1996-01-01 00:00:00")
    layer = F.posexplode(F.array(*[F.lit(name) for name in ("landing", "bronze", "silver", "gold")]))
    return product_lines(spark, sf_dir).select("*", layer.alias("step", "target_layer_name")).select(
        F.concat_ws("-", "target_layer_name", "line").alias("table_id"),
        F.col("line").alias("source_table_name"),
        F.col("line").alias("target_table_name"),
        "target_layer_name",
        (F.col("first_part") % 7 != 0).alias("active_flag"),
        (F.col("high") % 5 == 0).alias("is_delete_flag"),
        ((F.col("n") + F.col("step")) % 3 == 0).alias("is_processed_flag"),
        (start + days("low")).alias("last_load_start_dt"),
        (start + days("high")).alias("last_load_end_dt"),
        F.lit(None).cast("bigint").alias("source_count"),
        F.lit(None).cast("bigint").alias("target_count"),
        ntz(str(FIRST_AT)).alias("dw_mdfctn_dt"),
        F.lit(FIRST_LOAD).alias("dw_load_id"),
    )


def landing_file_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots registered so far: one per part, under the table of its line."""
    line = F.concat_ws("_", F.lower(F.regexp_replace("p_brand", "#", "_")), F.lower("p_type"))
    return given(spark, sf_dir, "part").select(
        F.concat_ws("-", F.lit("bronze"), line).alias("table_id"),
        line.alias("table_name"),
        F.concat_ws("/", F.lit("landing_files"), line, F.col("p_partkey").cast("string")).alias("file_path"),
        (ntz("1996-01-01 00:00:00") + days("p_size")).alias("delta_load_dt"),
        ntz(str(FIRST_AT)).alias("file_create_dt"),
        (F.col("p_partkey") % 2 == 0).alias("is_processed_flag"),
        F.lit(FIRST_LOAD).alias("dw_load_id"),
    )


def state_of(event_id: str) -> Column:
    step = F.col(event_id) % 3
    return F.when(step == 0, "Started").when(step == 1, "Success").otherwise("Failed")


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "events").select(
        F.col("event_type").alias("task_name"),
        F.col("user_id").alias("job_exec_dtl_id"),
        state_of("event_id").alias("exec_status"),
        "ts",
        "event_id",
    )


def run_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per event; a run that has only started has no end."""
    return given(spark, sf_dir, "events").select(
        F.col("user_id").alias("job_name"),
        F.col("event_id").alias("job_exec_id"),
        state_of("event_id").alias("exec_status"),
        F.col("ts").alias("wf_start_datetime"),
        F.when(F.col("event_id") % 3 != 0, F.col("ts") + days(F.col("event_id") % 11)).alias("wf_end_datetime"),
    )


def run_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs with the message that a run still open carries."""
    open_run = F.when(F.col("exec_status") == "Started", "In Progress")
    return run_headers(spark, sf_dir).withColumn("status_message", open_run)
