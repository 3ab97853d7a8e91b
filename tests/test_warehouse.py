"""CSV to gold for two windows, then a repeat of the second; failures and gates."""

from __future__ import annotations

from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.frames import AUDIT, VERSIONS, D, rows
from tidemark.operators import daily_sales, open_versions
from tidemark.operators.sales import fact_sales
from tidemark.operators.scd2 import conflicting_changes
from tidemark.plans import LoadError, Warehouse
from tidemark.plans.loads import CONTROL, FILES, KEYS, RUNS, Run
from tidemark.sources.tables import by_day

TIMES = "create_dt timestamp_ntz, mdfctn_dt timestamp_ntz"
BUSINESS = {
    "f_orders": f"order_id bigint, customer_id bigint, order_date date, order_status string, {TIMES}",
    "f_order_items": "order_item_id bigint, order_id bigint, product_id bigint, quantity decimal(12,2), "
    f"unit_price decimal(12,2), discount decimal(12,2), {TIMES}",
    "d_customers": f"customer_id bigint, name string, {TIMES}",
    "d_products": f"product_id bigint, name string, {TIMES}",
}
KEY = {"f_orders": "order_id", "f_order_items": "order_item_id", "d_customers": "customer_id", "d_products": "product_id"}
FACT = (
    "order_item_id bigint, order_id bigint, product_id bigint, customer_id bigint, order_date date, "
    "order_status string, quantity decimal(12,2), unit_price decimal(12,2), gross_amount decimal(18,2), "
    f"discount decimal(12,2), net_sales_amount decimal(18,2), {TIMES}, {AUDIT}"
)
DAILY = (
    "order_date date, total_orders bigint, total_customers bigint, total_revenue decimal(18,2), "
    f"total_items_sold decimal(18,2), avg_order_value decimal(18,2), {AUDIT}"
)
LAYERS = ["landing", "bronze", "silver", "gold"]
ONE = ("2024-01-01 00:00:00", "2024-01-10 23:59:59")
TWO = ("2024-01-10 23:59:59", "2024-01-20 23:59:59")


class Clock:
    def __init__(self):
        self.now = D("2024-03-01 08:00:00")

    def __call__(self):
        self.now += timedelta(seconds=1)
        return self.now


def write_csv(root, name, lines):
    folder = root / "source_files" / name
    folder.mkdir(parents=True, exist_ok=True)
    head = ",".join(c.split()[0] for c in BUSINESS[name].replace("decimal(12,2)", "d").split(", "))
    (folder / f"{name}.csv").write_text("\n".join([head, *lines]) + "\n")


def first_extract(root):
    t = "2024-01-05 10:00:00"
    write_csv(root, "f_orders", [f"{i},{i % 2},2024-01-0{i},O,{t},{t}" for i in (1, 2, 3)])
    write_csv(root, "f_order_items", [f"{10 * i + j},{i},{j},2,5.00,0.50,{t},{t}" for i in (1, 2, 3) for j in (1, 2)])
    write_csv(root, "d_customers", [f"0,Ann,{t},{t}", f"1,\"Bob, Jr\",{t},{t}"])
    write_csv(root, "d_products", [f"1,Nut,{t},{t}", f"2,Bolt,{t},{t}", "3,Cog,someday,2024-01-05"])


def second_extract(root):
    t, u = "2024-01-05 10:00:00", "2024-01-15 10:00:00"
    orders = [f"1,1,2024-01-01,O,{t},{t}", f"2,0,2024-01-02,F,{u},{u}", f"4,1,2024-01-02,O,{u},{u}"]
    write_csv(root, "f_orders", [*orders, f"3,1,2024-01-03,C,{t},{u}"])
    write_csv(root, "f_order_items", [f"41,4,1,1,7.00,0.00,{u},{u}", f"21,2,1,3,5.00,0.50,{u},{u}"])
    write_csv(root, "d_customers", [f"0,Anna,{u},{u}", f"2,Cy,{u},{u}"])
    write_csv(root, "d_products", [f"1,Nut M4,{u},{u}", f"4,Gear,{u},{u}"])


def build(spark, root, names=tuple(BUSINESS), **options):
    house = Warehouse(spark, str(root), clock=Clock(), **options)
    house.create_audit_tables()
    control, files, keys = [], [], []
    for name in names:
        columns = BUSINESS[name]
        house.create_table(f"bronze/{name}", f"{columns}, {AUDIT}")
        if name.startswith("d_"):
            house.create_table(f"silver/{name}", f"{name[2:-1]}_sk bigint, {columns}, {VERSIONS}")
        else:
            house.create_table(f"silver/{name}", f"{columns}, {AUDIT}", layout=by_day("create_dt"))
        control += [(f"{layer}-{name}", name, name, layer) for layer in LAYERS[:3]]
        files.append((f"bronze-{name}", name))
        keys.append((name, KEY[name]))
    house.create_table("gold/fact_sales", FACT, layout=by_day("order_date"))
    house.create_table("gold/daily_sales_aggt", DAILY)
    keys.append(("fact_sales", "order_item_id"))
    control += [(f"gold-{name}", name, name, "gold") for name in ("fact_sales", "daily_sales_aggt")]
    house.append(
        CONTROL,
        spark.createDataFrame(
            [(*c, True, False, True, D(ONE[0]), D(ONE[0])) for c in control],
            "table_id string, source_table_name string, target_table_name string, target_layer_name string, "
            "active_flag boolean, is_delete_flag boolean, is_processed_flag boolean, "
            "last_load_start_dt timestamp_ntz, last_load_end_dt timestamp_ntz",
        ),
    )
    house.append(FILES, spark.createDataFrame(files, "table_id string, table_name string"))
    house.append(KEYS, spark.createDataFrame(keys, "table_name string, primary_key string"))
    return house


def run_all(house, load_id, end, layers=LAYERS):
    run = Run(load_id, load_id + "-e", load_id + "-d", "daily")
    house.initialize(run, layers, end=end)
    house.open_run(run)
    counts = {layer: house.run_layer(layer, run) for layer in layers}
    house.close_run(run, layers)
    return counts


def business(df):
    return rows(df.select([c for c in df.columns if not c.startswith("dw_") and not c.endswith("_sk")]))


def test_two_windows_and_a_repeat(spark, tmp_path):
    house = build(spark, tmp_path)
    read = house.tables.read
    first_extract(tmp_path)
    counts = run_all(house, "L1", ONE[1])
    assert counts["landing"]["d_products"].source == 3
    assert counts["bronze"]["d_products"].source == 2  # the row with an unreadable date is set aside
    assert spark.read.parquet(f"{house.root}/rejected/bronze/d_products/L1").count() == 1
    assert counts["silver"]["f_orders"] == counts["gold"]["fact_sales"].__class__(3, 3, 3, 0)
    assert counts["gold"]["fact_sales"].inserted == 6
    assert counts["gold"]["daily_sales_aggt"].source == 3
    check_gold(house)
    keys = {r.customer_id: r.customer_sk for r in read("silver/d_customers").collect()}
    assert sorted(keys.values()) == [1, 2]
    untouched = set(read("silver/f_orders", {"2024-01-05"}).inputFiles())

    second_extract(tmp_path)
    counts = run_all(house, "L2", TWO[1])
    assert counts["bronze"]["f_orders"].source == 3
    # Order 3 was created before the window: its change reaches bronze, not silver.
    status = {r.order_id: r.order_status for r in read("bronze/f_orders").collect()}
    assert status == {1: "O", 2: "F", 3: "C", 4: "O"}
    status = {r.order_id: r.order_status for r in read("silver/f_orders").collect()}
    assert status == {1: "O", 2: "F", 3: "O", 4: "O"}
    assert (counts["silver"]["f_orders"].inserted, counts["silver"]["f_orders"].updated) == (1, 1)
    assert set(read("silver/f_orders", {"2024-01-05"}).inputFiles()).isdisjoint(untouched)

    customers = read("silver/d_customers").collect()
    history = sorted((r.customer_id, r.name, r.dw_eff_end_dt) for r in customers if r.customer_id == 0)
    assert history == [(0, "Ann", D(TWO[1])), (0, "Anna", None)]
    assert sorted(r.customer_sk for r in customers) == [1, 2, 3, 4]
    assert keys.items() <= {r.customer_id: r.customer_sk for r in customers if r.dw_load_id == "L1"}.items()
    # Products are only ever added: the known product keeps its first version.
    assert business(read("silver/d_products")).keys() == {
        (1, "Nut", D("2024-01-05 10:00:00"), D("2024-01-05 10:00:00")),
        (2, "Bolt", D("2024-01-05 10:00:00"), D("2024-01-05 10:00:00")),
        (4, "Gear", D("2024-01-15 10:00:00"), D("2024-01-15 10:00:00")),
    }
    check_gold(house)
    daily = {str(r.order_date): r for r in read("gold/daily_sales_aggt").collect()}
    assert daily["2024-01-02"].dw_load_id == "L2" and daily["2024-01-01"].dw_load_id == "L1"
    assert daily["2024-01-02"].total_orders == 2

    before = {name: business(read(name)) for name in ("silver/f_orders", "silver/d_customers", "gold/fact_sales")}
    run = Run("L3", "e", "d", "daily")
    house.initialize(run, LAYERS[2:], start=TWO[0], end=TWO[1])
    house.run_layer("silver", run)
    house.run_layer("gold", run, day=("2024", "1", "15"))
    assert {name: business(read(name)) for name in before} == before
    check_gold(house)

    runs = {r.master_job_id: r for r in read(RUNS).collect()}
    assert runs["L2"].exec_status == "Success" and runs["L2"].data_load_end_dt == D(TWO[1])
    log = {(r.task_name, r.job_exec_dtl_id): r for r in house.task_log().collect()}
    done = log[("C_bronze_silver_f_orders", "L2-d")]
    assert (done.exec_status, done.insert_count, done.update_count) == ("Success", 1, 1)
    assert done.start_datetime < done.end_datetime
    assert {r.exec_status for r in log.values()} == {"Success"}


def check_gold(house):
    """Gold equals what silver gives when computed from scratch."""
    items, orders = house.tables.read("silver/f_order_items"), house.tables.read("silver/f_orders")
    daily = house.tables.read("gold/daily_sales_aggt")
    assert business(daily) == business(daily_sales(items, orders))
    fact = house.tables.read("gold/fact_sales")
    want = fact_sales(items, orders).select("order_item_id", "net_sales_amount", "order_id")
    assert rows(fact.select(want.columns)) == rows(want)


def test_a_changed_table_is_versioned_when_asked(spark, tmp_path):
    names = ("d_products", "f_orders")
    house = build(spark, tmp_path, names, silver_kinds={"d_products": "scd2"}, silver_mode="either")
    first_extract(tmp_path)
    run_all(house, "L1", ONE[1], LAYERS[:3])
    closed_then = house.tables.read("silver/d_products", {"closed"})
    assert closed_then.isEmpty()
    second_extract(tmp_path)
    run_all(house, "L2", TWO[1], LAYERS[:3])
    products = house.tables.read("silver/d_products")
    assert Counter(r.product_id for r in products.collect()) == Counter({1: 2, 2: 1, 4: 1})
    assert open_versions(products).where("product_id = 1").collect()[0].name == "Nut M4"
    assert [r.name for r in house.tables.read("silver/d_products", {"closed"}).collect()] == ["Nut"]
    # With either time in the window the late change of order 3 does reach silver.
    assert house.tables.read("silver/f_orders").where("order_id = 3").collect()[0].order_status == "C"


def test_an_ambiguous_merge_fails_its_table_only_and_a_repeat_finishes(spark, tmp_path):
    house = build(spark, tmp_path, ("d_customers", "f_orders"))
    t, u = "2024-01-05 10:00:00", "2024-01-06 10:00:00"
    first_extract(tmp_path)
    run = Run("L1", "e", "d", "daily")
    house.initialize(run, LAYERS, end=ONE[1])
    house.open_run(run)
    house.run_layer("landing", run)
    house.run_layer("bronze", run)
    write_csv(tmp_path, "d_customers", [f"0,Ann,{t},{t}", f"0,Ana,{t},{u}"])
    again = Run("L2", "e", "d2", "daily")
    house.initialize(again, ["landing", "bronze"], start=ONE[0], end=ONE[1])
    house.run_layer("landing", again)
    with pytest.raises(LoadError, match="failed in bronze: d_customers"):
        house.run_layer("bronze", again)
    left = house.tables.read(CONTROL).where(~F.col("is_processed_flag") & (F.col("target_layer_name") == "bronze"))
    assert [r.target_table_name for r in left.collect()] == ["d_customers"]
    log = {(r.task_name, r.job_exec_dtl_id): r for r in house.task_log().collect()}
    assert log[("C_landing_bronze_d_customers", "d2")].exec_status == "Failed"
    assert "several source rows" in log[("C_landing_bronze_d_customers", "d2")].status_message
    assert house.fail_run(run) == "There are unprocessed tables in the cntrl_stm_mapping table."
    with pytest.raises(LoadError, match="the last run of daily failed"):
        house.initialize(again, LAYERS)
    with pytest.raises(LoadError, match="unprocessed: 'd_customers"):
        house.close_run(run, ["bronze"])

    first_extract(tmp_path)
    other = Run("L4", "e4", "d4", "repair")
    house.initialize(other, ["landing"], start=ONE[0], end=ONE[1])
    house.run_layer("landing", other)
    assert set(house.run_layer("bronze", other)) == {"d_customers"}


def test_an_empty_change_set_is_processed_without_a_snapshot(spark, tmp_path):
    house = build(spark, tmp_path, ("d_customers", "f_orders", "f_order_items"))
    first_extract(tmp_path)
    run = Run("L1", "e", "d", "daily")
    house.initialize(run, LAYERS, start="2020-01-01", end="2020-01-02")
    counts = {layer: house.run_layer(layer, run) for layer in LAYERS}
    assert {c for layer in counts.values() for c in layer.values()} == {counts["gold"]["fact_sales"].__class__()}
    assert house.tables.read(FILES).where("file_path is not null").isEmpty()
    assert house.run_layer("gold", run) == {}


def test_copies_of_a_new_key_are_all_loaded_and_all_updated_later(spark, tmp_path):
    house = build(spark, tmp_path, ("d_customers",))
    t, u = "2024-01-05 10:00:00", "2024-01-06 10:00:00"
    write_csv(tmp_path, "d_customers", [f"0,Ann,{t},{t}", f"7,Gil,{t},{t}", f"7,Gus,{t},{u}", f",Nil,{t},{t}"])
    run_all(house, "L1", ONE[1], LAYERS[:2])
    names = Counter(r.name for r in house.tables.read("bronze/d_customers").collect())
    assert names == Counter(["Ann", "Gil", "Gus", "Nil"])
    assert house.tables.has_copies("bronze/d_customers")
    write_csv(tmp_path, "d_customers", [f"7,Guy,{t},2024-01-15 00:00:00"])
    run_all(house, "L2", TWO[1], LAYERS[:2])
    stored = house.tables.read("bronze/d_customers")
    assert Counter(r.name for r in stored.collect()) == Counter(["Ann", "Guy", "Guy", "Nil"])
    assert stored.where("dw_update_id = 'L2'").count() == 2


def test_rows_set_aside_by_landing_and_bronze_are_all_kept(spark, tmp_path):
    house = build(spark, tmp_path, ("d_products",))
    t = "2024-01-05 10:00:00"
    write_csv(tmp_path, "d_products", [f"1,Nut,{t},{t}", "2,Bolt,someday,sometime", f"3,Cog,someday,{t}"])
    run_all(house, "L1", ONE[1], LAYERS[:2])
    kept = {layer: spark.read.parquet(f"{house.root}/rejected/{layer}/d_products/L1") for layer in LAYERS[:2]}
    assert {layer: [r.product_id for r in df.collect()] for layer, df in kept.items()} == {"landing": ["2"], "bronze": ["3"]}


def test_a_merge_repeated_over_odd_slices_adds_nothing(spark, tmp_path):
    house = build(spark, tmp_path, ("f_orders",))
    t = "2024-01-05 10:00:00"
    write_csv(tmp_path, "f_orders", [f"1,1,2024-01-01,O,{t},{t}", f"2,1,2024-01-01,O,,{t}", f"3,1,,,{t},{t}"])
    run_all(house, "L1", ONE[1], LAYERS[:2])
    before = business(house.tables.read("bronze/f_orders"))
    again = Run("L2", "e", "d", "daily")
    house.initialize(again, LAYERS[:2], start=ONE[0], end=ONE[1])
    for layer in LAYERS[:2]:
        house.run_layer(layer, again)
    assert business(house.tables.read("bronze/f_orders")) == before and sum(before.values()) == 3


def test_facts_are_laid_out_by_month_unless_asked_otherwise(spark, tmp_path):
    house = build(spark, tmp_path, ("f_orders",))
    assert house.tables.layout("bronze/f_orders") == "month:create_dt"
    assert house.tables.layout("silver/f_orders") == "day:create_dt"
    assert house.tables.layout("gold/daily_sales_aggt") is None


def test_insert_absent_may_repeat_keys_and_windows(spark, tmp_path):
    house = build(spark, tmp_path, ("d_products",))
    t, u = "2024-01-05 10:00:00", "2024-01-06 10:00:00"
    write_csv(tmp_path, "d_products", [f"1,Nut,{t},{t}", f"1,Nut M4,{t},{u}", f"2,Bolt,{t},{t}"])
    run_all(house, "L1", ONE[1], LAYERS[:3])
    before = business(house.tables.read("silver/d_products"))
    assert sum(before.values()) == 3
    again = Run("L2", "e", "d", "daily")
    house.initialize(again, ["silver"], start=ONE[0], end=ONE[1])
    house.run_layer("silver", again)
    assert business(house.tables.read("silver/d_products")) == before


def test_scd2_stops_only_at_a_real_conflict(spark, tmp_path):
    house = build(spark, tmp_path, ("d_customers",))
    t, u, v = "2024-01-05 10:00:00", "2024-01-15 10:00:00", "2024-01-16 10:00:00"
    write_csv(tmp_path, "d_customers", [f"0,Ann,{t},{t}", f"1,Bob,{t},{t}"])
    run_all(house, "L1", ONE[1], LAYERS[:3])
    silver = house.tables.read("silver/d_customers")
    same = spark.createDataFrame([(0, D(t)), (0, D(t)), (0, D(u)), (1, None), (1, None), (7, D(u)), (7, D(v))], "customer_id long, mdfctn_dt timestamp_ntz")
    assert conflicting_changes(silver, same, ["customer_id"]).isEmpty()
    more = same.union(spark.createDataFrame([(0, D(v)), (1, D(u)), (1, D(u))], same.schema))
    assert rows(conflicting_changes(silver, more, ["customer_id"])) == Counter([(0, 2), (1, 2)])


def test_an_unknown_gold_table_is_an_error(spark, tmp_path):
    house = build(spark, tmp_path, ("f_orders", "f_order_items"))
    house.tables.update(CONTROL, lambda c: c.withColumn("target_table_name", F.when(F.col("target_table_name") == "fact_sales", "fact_other").otherwise(F.col("target_table_name"))))
    run = Run("L1", "e", "d", "daily")
    house.initialize(run, ["gold"], start=ONE[0], end=ONE[1])
    with pytest.raises(LoadError, match="failed in gold: fact_other"):
        house.run_layer("gold", run)


def test_two_drivers_load_tables_of_their_own(spark, tmp_path):
    names = ("f_orders", "f_order_items")
    house = build(spark, tmp_path, names)
    first_extract(tmp_path)
    run_all(house, "L1", ONE[1], LAYERS[:2])
    run = Run("L2", "e", "d", "daily")
    house.initialize(run, ["silver"], start=ONE[0], end=ONE[1])
    houses = [Warehouse(spark, str(tmp_path), clock=Clock()) for _ in names]
    with ThreadPoolExecutor(2) as pool:
        jobs = [pool.submit(h.run_layer, "silver", run, tables=[n]) for h, n in zip(houses, names, strict=True)]
        done = {name for job in jobs for name in job.result()}
    assert done == set(names)
    marked = house.tables.read(CONTROL).where("target_layer_name = 'silver' and is_processed_flag")
    assert {r.target_table_name for r in marked.collect()} == set(names)
    assert house.run_layer("silver", run) == {}
    log = {r.task_name for r in house.task_log().where("job_exec_dtl_id = 'd' and exec_status = 'Success'").collect()}
    assert log == {f"C_bronze_silver_{n}" for n in names}


def test_an_error_while_marking_is_that_tables_failure(spark, tmp_path, monkeypatch):
    house = build(spark, tmp_path, ("f_orders", "f_order_items"))
    first_extract(tmp_path)
    run_all(house, "L1", ONE[1], LAYERS[:2])
    run = Run("L2", "e", "d", "daily")
    house.initialize(run, ["silver"], start=ONE[0], end=ONE[1])
    mark = house._mark_processed

    def broken(layer, row, *rest):
        if row.target_table_name == "f_orders":
            raise RuntimeError("lost")
        mark(layer, row, *rest)

    with monkeypatch.context() as patch:
        patch.setattr(house, "_mark_processed", broken)
        with pytest.raises(LoadError, match="failed in silver: f_orders"):
            house.run_layer("silver", run)
    assert set(house.run_layer("silver", run, tables=["f_orders"])) == {"f_orders"}


def test_lines_with_too_many_or_too_few_fields_are_set_aside_whole(spark, tmp_path):
    house = build(spark, tmp_path, ("f_orders",))
    t = "2024-01-05 10:00:00"
    write_csv(tmp_path, "f_orders", [f"1,1,2024-01-01,O,{t},{t}", f"2,1,2024-01-01,O,{t},{t},more", "3", f"4,\"1\",2024-01-01,\"O\",{t},{t}"])
    counts = run_all(house, "L1", ONE[1], LAYERS[:2])
    assert counts["landing"]["f_orders"].source == 2
    assert {r.order_id for r in house.tables.read("bronze/f_orders").collect()} == {1, 4}
    rejected = spark.read.parquet(f"{house.root}/rejected/landing/f_orders/L1")
    assert {r.dw_ragged_line for r in rejected.collect()} == {f"2,1,2024-01-01,O,{t},{t},more", "3"}


@pytest.mark.parametrize("unit", ["day", "month"])
def test_daily_aggregate_in_folders(spark, tmp_path, unit):
    """The refresh equals a full recompute, also for a date whose only order moves away."""
    house = build(spark, tmp_path, daily_partitions=unit, silver_mode="either", include_order_changes=True)
    first_extract(tmp_path)
    counts = run_all(house, "L1", ONE[1])
    assert counts["gold"]["daily_sales_aggt"].source == 3
    silver = lambda: (house.read("silver/f_order_items"), house.read("silver/f_orders"))
    assert business(house.read("gold/daily_sales_aggt")) == business(daily_sales(*silver()))
    assert house.tables.read("gold/daily_sales_aggt").isEmpty()
    files = {str(r.order_date): r.f for r in house.read("gold/daily_sales_aggt").select("order_date", F.input_file_name().alias("f")).collect()}
    second_extract(tmp_path)
    run_all(house, "L2", TWO[1])
    assert business(house.read("gold/daily_sales_aggt")) == business(daily_sales(*silver()))
    after = {str(r.order_date): r.f for r in house.read("gold/daily_sales_aggt").select("order_date", F.input_file_name().alias("f")).collect()}
    assert (after["2024-01-01"] == files["2024-01-01"]) == (unit == "day")
    assert after["2024-01-02"] != files["2024-01-02"]
