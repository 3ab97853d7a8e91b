from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.frames import LOAD_AT, D, rows
from tidemark.operators import append_rows, keyed_update, update_from
from tidemark.plans import control as ctl
from tidemark.plans.loads import AUDIT_TABLES, CONTROL, FILES
from tidemark.plans.runlog import latest_run, run_log_current

A, B = D("2024-01-01"), D("2024-01-02")


def control(spark, *given):
    """(name, layer, active, deleted, processed)"""
    data = [(f"{layer}-{n}", n, n, layer, a, d, p, A, B, None, None, A, "L0") for n, layer, a, d, p in given]
    return spark.createDataFrame(data, AUDIT_TABLES[CONTROL])


FLAGS = [
    ("due", True, False, False),
    ("done", True, False, True),
    ("off", False, False, False),
    ("deleted", True, True, False),
    ("unknown", None, None, None),
]


@pytest.fixture(scope="module")
def table(spark):
    return control(spark, *[(n, layer, *f) for layer in ctl.LAYERS for n, *f in FLAGS])


def names(df):
    return sorted(r.target_table_name for r in df.collect())


def test_pending_per_layer(table):
    assert names(ctl.pending(table, "landing")) == ["due"]
    assert names(ctl.pending(table, "bronze")) == ["deleted", "due"]
    assert names(ctl.pending(table, "silver")) == ["deleted", "due", "unknown"]
    assert names(ctl.pending(table, "gold")) == ["deleted", "due", "unknown"]
    assert ctl.pending(table).count() == 9


def test_pending_landing_finds_the_bronze_table_only(table):
    found = ctl.pending_landing(table).collect()
    assert [(r.bronze_table_id, r.bronze_table_name, r.table_id) for r in found] == [("bronze-due", "due", "landing-due")]


def test_advance_window_uses_old_values_and_live_tables_only(spark):
    before = control(
        spark, ("x", "landing", True, False, True), ("y", "landing", False, False, True), ("z", "gold", True, False, True)
    )
    after = {r.table_id: r for r in ctl.advance_window(before, ["landing"], LOAD_AT, "L1").collect()}
    x = after["landing-x"]
    assert (x.last_load_start_dt, x.last_load_end_dt) == (B, D("2024-01-31 23:59:59"))
    assert (x.is_processed_flag, x.dw_load_id, x.dw_mdfctn_dt) == (False, "L1", LOAD_AT)
    assert after["landing-y"].dw_load_id == after["gold-z"].dw_load_id == "L0"
    given = ctl.advance_window(before, ["landing"], LOAD_AT, "L1", start="2023-05-01", end="2023-05-02 01:00:00")
    x = {r.table_id: r for r in given.collect()}["landing-x"]
    assert (x.last_load_start_dt, x.last_load_end_dt) == (D("2023-05-01"), D("2023-05-02 01:00:00"))


def test_unprocessed_counts_live_tables(table):
    assert rows(ctl.unprocessed_names(table, ["gold", "silver"])) == Counter([("gold", 1, "due"), ("silver", 1, "due")])
    assert ctl.unprocessed(table).count() == 4


def test_run_outcome(spark, table):
    assert rows(ctl.run_outcome(table)) == Counter(
        [("Failed", "Listed tables remained unprocessed: 'due, due, due, due'", None, None)]
    )
    done = control(spark, ("x", "gold", True, False, True), ("y", "gold", False, False, False))
    assert rows(ctl.run_outcome(done)) == Counter([("Success", "Workflow completed successfully.", A, B)])
    mixed = control(spark, ("x", "gold", True, False, True), ("y", "silver", True, False, False))
    assert rows(ctl.run_outcome(mixed, ["gold"])).keys() == {("Success", "Workflow completed successfully.", A, B)}
    assert ctl.run_outcome(mixed, ["silver"]).collect()[0].exec_status == "Failed"
    assert ctl.failure_message(mixed) == ctl.RUN_HAS_UNPROCESSED
    assert ctl.failure_message(done) == ctl.RUN_HAS_FAILURES


def test_load_range_of_nothing_is_null(spark):
    assert rows(ctl.load_range(control(spark, ("x", "gold", True, False, False)))) == Counter([(None, None)])


def files(spark, *given):
    return spark.createDataFrame(
        [(t, t.split("-")[1], path, at, A, flag, "L0") for t, path, at, flag in given], AUDIT_TABLES[FILES]
    )


def test_pick_files_wants_the_exact_window_end(spark):
    due = control(spark, *[(n, "bronze", True, False, False) for n in ("x", "y", "z")])
    registry = files(
        spark,
        ("bronze-x", "p2", B, False),
        ("bronze-x", "p1", B, False),
        ("bronze-x", "p0", A, False),
        ("bronze-y", "p3", B, True),
        ("bronze-z", "p4", A, False),
    )
    picked = {r.target_table_name: r.file_path for r in ctl.pick_files(registry, due).collect()}
    assert picked == {"x": "p1", "y": None, "z": None}


def test_register_files_updates_and_never_inserts(spark):
    registry = files(spark, ("bronze-x", "old", A, True), ("bronze-y", "old", A, True))
    written = spark.createDataFrame(
        [("bronze-x", "new", B), ("bronze-q", "new", B)], "table_id string, file_path string, delta_load_dt timestamp_ntz"
    )
    assert rows(ctl.register_files(registry, written, LOAD_AT, "L1")) == Counter(
        [("bronze-x", "x", "new", B, LOAD_AT, False, "L1"), ("bronze-y", "y", "old", A, A, True, "L0")]
    )


def test_keyed_update_treats_null_as_no_hit_and_reads_old_values(spark):
    df = spark.createDataFrame([(1, 10, 20), (2, 10, 20), (None, 10, 20)], "k int, a int, b int")
    got = keyed_update(df, F.col("k") == 1, {"a": F.col("b"), "b": F.col("a")})
    assert rows(got) == Counter([(1, 20, 10), (2, 10, 20), (None, 10, 20)])


def test_update_from_can_set_null_and_skips_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    updates = spark.createDataFrame([(1, None), (3, "x")], "k int, v string")
    assert rows(update_from(df, updates, ["k"], ["v"])) == Counter([(1, None), (2, "b"), (None, "c")])


def test_append_rows_by_name_with_literals(spark):
    target = spark.createDataFrame([(1, "a", 2.5)], "k bigint, v string, w double")
    more = spark.createDataFrame([("b", 2)], "v string, k int")
    assert rows(append_rows(target, more, w=F.lit("4"))) == Counter([(1, "a", 2.5), (2, "b", 4.0)])
    assert rows(append_rows(target, more)) == Counter([(1, "a", 2.5), (2, "b", None)])


RUNS = "job_name string, job_exec_id bigint, exec_status string, wf_end_datetime timestamp_ntz"


def test_latest_run_counts_an_open_run_only_if_none_has_ended(spark):
    runs = spark.createDataFrame(
        [("j", 1, "Success", A), ("j", 2, "Failed", B), ("j", 3, "Started", None), ("k", 4, "Started", None)], RUNS
    )
    assert {r.job_name: r.job_exec_id for r in latest_run(runs).collect()} == {"j": 2, "k": 4}
    assert latest_run(runs.limit(0)).isEmpty()


def test_run_log_keeps_the_last_event(spark):
    events = spark.createDataFrame(
        [("t", 1, "Started", A, 1), ("t", 1, "Success", B, 2), ("u", 1, "Failed", B, 4), ("u", 1, "Started", B, 3)],
        "task_name string, job_exec_dtl_id int, exec_status string, ts timestamp_ntz, seq int",
    )
    last = run_log_current(events, ["task_name", "job_exec_dtl_id"], ["ts", "seq"])
    assert {r.task_name: r.exec_status for r in last.collect()} == {"t": "Success", "u": "Failed"}
    assert last.columns == events.columns
