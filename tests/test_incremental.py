"""Key ranges, buckets, mergeable distinct counts and folders per day: what spares a load the whole table."""

from __future__ import annotations

import random
import uuid
from collections import Counter
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tests.frames import AUDIT, LOAD_AT, NEW, OLD, UPDATED, D, rows
from tidemark.operators import (
    daily_from_state,
    daily_sales,
    daily_state,
    distinct_counts,
    distinct_state,
    matched_keys,
    merge_daily,
    merge_states,
    upsert,
    within_key_range,
)
from tidemark.sources import EventLog, PartitionedTable, save_bucketed, stage, upsert_bucketed
from tidemark.sources.bucketed import bucket_count

COLUMNS = "a bigint, b string, v bigint"
TARGET = COLUMNS + ", " + AUDIT


def plan_of(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


# Key ranges


def test_key_range_reaches_the_scan(spark):
    target = stage(spark.range(1000).select(F.col("id").alias("a"), F.col("id").cast("string").alias("b")), "target")
    source = spark.createDataFrame([(10, "x"), (20, None), (None, "y"), (15, "zz")], "a int, b string")
    found = within_key_range(target, source, ["a"])
    assert sorted(r.a for r in found.collect()) == list(range(10, 21))
    text = plan_of(found)
    assert "GreaterThanOrEqual(a,10)" in text and "LessThanOrEqual(a,20)" in text
    both = plan_of(within_key_range(target, source, ["a", "b"]))
    assert "GreaterThanOrEqual(b,x)" in both and "LessThanOrEqual(b,zz)" in both and "LessThanOrEqual(a,15)" in both


@pytest.mark.parametrize("keys", [["a"], ["b"], ["a", "b"]])
def test_key_range_keeps_all_matches(spark, keys):
    rng = random.Random(len(keys))
    value = lambda: (rng.choice([None, *range(30)]), rng.choice([None, "", "a", "é", "zz", "Z"]), rng.randrange(9))
    target = stage(spark.createDataFrame([value() for _ in range(300)], COLUMNS), "target")
    for n in (0, 1, 8):
        source = spark.createDataFrame([value() for _ in range(n)], COLUMNS)
        near = within_key_range(target, source, keys)
        assert rows(matched_keys(near, source, keys)) == rows(matched_keys(target, source, keys))


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz", "decimal(9,2)", "double", "boolean", "binary"])
def test_key_range_of_other_types(spark, kind):
    texts = {"date": ["2024-01-0%d" % i for i in range(1, 9)], "boolean": ["true", "false"] * 4, "binary": list("abcdefgh")}
    texts["timestamp_ntz"] = [t + " 10:00:00.123456" for t in texts["date"]]
    values = texts.get(kind, [str(i / 4) for i in range(8)])
    target = stage(spark.createDataFrame([(v,) for v in values], "k string").select(F.col("k").cast(kind)), "target")
    source = target.orderBy("k").limit(5)
    near = within_key_range(target, source, ["k"])
    assert rows(matched_keys(near, source, ["k"])) == rows(matched_keys(target, source, ["k"]))


# Buckets


def bucketed_merge(spark, stored, new, keys=("a",), buckets=5):
    name = f"t_{uuid.uuid4().hex}"
    target = save_bucketed(spark.createDataFrame([(*r, *OLD) for r in stored], TARGET), name, list(keys), buckets)
    assert bucket_count(spark, name, list(keys)) == buckets
    source = spark.createDataFrame(new, COLUMNS)
    after = upsert_bucketed(spark, name, source, list(keys), "L1", LOAD_AT, f"{name}_next")
    got = rows(after)
    assert got == rows(upsert(target, source, list(keys), "L1", LOAD_AT))
    assert bucket_count(spark, f"{name}_next", list(keys)) == buckets
    for table in (name, f"{name}_next"):
        spark.sql(f"drop table {table}")
    return got


def test_bucketed_merge_is_an_upsert(spark):
    got = bucketed_merge(spark, [(1, "x", 1), (2, "y", 2), (None, "n", 3)], [(2, "y", 20), (4, None, None), (None, "m", 5)])
    assert got == Counter(
        [(1, "x", 1, *OLD), (2, "y", 20, *UPDATED), (None, "n", 3, *OLD), (4, None, None, *NEW), (None, "m", 5, *NEW)]
    )
    bucketed_merge(spark, [(i, str(i % 7), i) for i in range(200)], [(i, str(i % 7), -i) for i in range(150, 260)], ("a", "b"))
    assert bucketed_merge(spark, [], []) == Counter()


def test_the_stored_side_is_not_shuffled_and_stays_bucketed(spark):
    name = f"t_{uuid.uuid4().hex}"
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = spark.range(500).select(F.col("id").alias("a"), F.lit("x").alias("b"), F.col("id").alias("v"))
        stamp = [F.lit(v).cast("timestamp_ntz" if i < 2 else "string").alias(c) for i, (c, v) in enumerate(zip(["dw_create_dt", "dw_mdfctn_dt", "dw_load_id", "dw_update_id"], OLD, strict=True))]
        save_bucketed(stored.select("*", *stamp), name, ["a"], 8)
        source = spark.createDataFrame([(1, "y", 1), (900, "z", 2)], COLUMNS)
        merged = upsert(spark.table(name), source, ["a"], "L1", LOAD_AT, plan="outer")
        text = merged._jdf.queryExecution().executedPlan().toString()
        tree = text.split("\n")
        scan = next(i for i, line in enumerate(tree) if "FileScan" in line and name in line and "isnotnull" in line.lower())
        # From the join down to the scan of the stored table there is no exchange.
        join = max(i for i in range(scan) if "SortMergeJoin" in tree[i])
        assert not any("Exchange" in line for line in tree[join:scan])
        assert sum("Exchange" in line for line in tree) >= 1  # the changes go to the table's buckets
        upsert_bucketed(spark, name, source, ["a"], "L1", LOAD_AT, f"{name}_next")
        files = [r[0] for r in spark.table(f"{name}_next").select(F.input_file_name()).distinct().collect()]
        assert len(files) <= 8
        assert spark.table(f"{name}_next").count() == 501
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    with pytest.raises(ValueError, match="bucketed by"):
        upsert_bucketed(spark, name, source, ["b"], "L1", LOAD_AT, "never")


# Distinct counts as states


def test_states_merge_to_exact_counts(spark):
    rng = random.Random(3)
    ids = [None, 0, -1, -40_000, 7, 32_767, 32_768, 1 << 40, (1 << 62) + 5]
    data = [(rng.choice(["a", "b", None]), rng.choice(ids), rng.choice(ids[:4])) for _ in range(300)] + [("c", None, None), ("d", 7, None)]
    parts = [data[::3], data[1::3], data[2::3], []]
    frames = [spark.createDataFrame(p, "g string, x bigint, y bigint") for p in parts]
    measures = {"xs": "x", "ys": "y"}
    state = merge_states(*[distinct_state(f, "g", measures) for f in frames])
    want = {g: (len({r[1] for r in data if r[0] == g} - {None}), len({r[2] for r in data if r[0] == g} - {None})) for g in "abd"}
    want[None] = (len({r[1] for r in data if r[0] is None} - {None}), len({r[2] for r in data if r[0] is None} - {None}))
    assert {r.g: (r.xs, r.ys) for r in distinct_counts(state, measures).collect()} == want
    # A state merged with itself is itself.
    assert rows(distinct_counts(merge_states(state, state), measures)) == rows(distinct_counts(state, measures))
    with pytest.raises(ValueError, match="whole numbers"):
        distinct_state(frames[0], "g", {"gs": "g"})


def test_daily_sales_from_parts(spark):
    rng = random.Random(8)
    orders = [(i, rng.choice([None, 1, 2, 3]), rng.choice([None, "2024-01-01", "2024-01-02"])) for i in range(40)]
    orders = spark.createDataFrame(orders, "order_id bigint, customer_id bigint, d string").select(
        "order_id", "customer_id", F.col("d").cast("date").alias("order_date")
    )
    items = [(rng.randrange(45), rng.randrange(1, 5), rng.randrange(1, 999), rng.choice([0, 50])) for _ in range(200)]
    items = spark.createDataFrame(items, "order_id bigint, quantity bigint, unit_price bigint, discount bigint").select(
        "order_id", *[(F.col(c) / 100).cast("decimal(12,2)").alias(c) for c in ("quantity", "unit_price", "discount")]
    )
    items = stage(items.withColumn("part", F.pmod(F.xxhash64("*"), F.lit(3))), "items")
    parts = [daily_state(items.where(F.col("part") == i), orders) for i in range(3)]
    assert rows(daily_from_state(*merge_daily(*parts))) == rows(daily_sales(items, orders))


# Folders per day or month

DAILY = "d date, n bigint, note string"


@pytest.mark.parametrize("unit", ["day", "month"])
def test_only_touched_folders_are_written(spark, tmp_path, unit):
    table = PartitionedTable(spark, str(tmp_path / "t"), spark.createDataFrame([], DAILY).schema, "d", unit)
    table.create()
    assert table.read().isEmpty()
    day = lambda text: D(text).date()
    first = [(day("2024-01-01"), 1, "a"), (day("2024-01-02"), 2, None), (day("2024-02-01"), 3, "c"), (None, 4, "d")]
    frame = spark.createDataFrame(first, DAILY)
    table.replace(frame, frame.select("d"))
    assert rows(table.read()) == Counter(first)
    files = lambda: {f.split("/t/")[1] for r in table.read().select(F.input_file_name()).distinct().collect() for f in r}
    before = files()

    # One day changes, one loses all its rows, one is new; a row of another day is not taken.
    fresh = spark.createDataFrame([(day("2024-01-01"), 10, "new"), (day("2024-03-05"), 7, "n"), (day("2024-02-01"), 99, "no")], DAILY)
    named = spark.createDataFrame([(day("2024-01-01"),), (day("2024-01-02"),), (day("2024-03-05"),)], "d date")
    for _ in range(2):
        table.replace(fresh, named)
        want = [(day("2024-01-01"), 10, "new"), (day("2024-03-05"), 7, "n"), (day("2024-02-01"), 3, "c"), (None, 4, "d")]
        assert rows(table.read()) == Counter(want)
    kept = {f for f in before if "2024-01" not in f}
    assert kept and kept <= files()

    # What loses its last row can come back; a missing date is a value as well.
    table.replace(fresh.limit(0), spark.createDataFrame([(day("2024-03-05"),), (None,)], "d date"))
    assert rows(table.read()) == Counter(want[:1] + want[2:3])
    table.replace(frame, spark.createDataFrame([(day("2024-01-02"),)], "d date"))
    assert rows(table.read()) == Counter([*want[:1], *want[2:3], first[1]])
    table.replace(frame, named.limit(0))
    assert table.read().count() == 3


def test_units_are_checked(spark, tmp_path):
    with pytest.raises(ValueError, match="unit"):
        PartitionedTable(spark, str(tmp_path), spark.createDataFrame([], DAILY).schema, "d", "week")


# Logs


def test_runs_append_side_by_side_and_are_put_together(spark, tmp_path):
    schema = "task string, n bigint"
    log = EventLog(spark, str(tmp_path / "log"), spark.createDataFrame([], schema).schema)
    assert log.read().isEmpty() and log.read("none").isEmpty()
    log.compact("none")
    runs = ["a/b", "a=b c", "ä%2F", ""]
    with ThreadPoolExecutor(4) as pool:  # two drivers for every run
        list(pool.map(lambda i: log.append(runs[i % 4], spark.createDataFrame([(f"t{i}", i)], schema)), range(16)))
    want = Counter((f"t{i}", i) for i in range(16))
    assert rows(log.read()) == want
    for k, run in enumerate(runs):
        assert rows(log.read(run)) == Counter((f"t{i}", i) for i in range(16) if i % 4 == k)
    others = {f for r in log.read("a=b c").select(F.input_file_name()).collect() for f in r}
    log.compact("a/b")
    log.compact("a/b")
    assert rows(log.read()) == want
    assert log.read("a/b").select(F.input_file_name()).distinct().count() == 1
    assert {f for r in log.read("a=b c").select(F.input_file_name()).collect() for f in r} == others
    log.append("a/b", spark.createDataFrame([("late", 99)], schema))
    assert rows(log.read("a/b")) == Counter([("t0", 0), ("t4", 4), ("t8", 8), ("t12", 12), ("late", 99)])


def test_an_event_costs_the_same_however_long_the_log_is(spark, tmp_path):
    schema = "task string, n bigint"
    log = EventLog(spark, str(tmp_path / "log"), spark.createDataFrame([], schema).schema)
    written = lambda: {str(p): p.stat().st_mtime_ns for p in (tmp_path / "log").rglob("*.parquet")}
    for i in range(12):
        before = written()
        log.append(f"run {i}", spark.createDataFrame([("t", i)], schema))
        after = written()
        assert len(after) == len(before) + 1 and before.items() <= after.items()
