from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.frames import AUDIT, LOAD_AT, NEW, OLD, UPDATED, VERSIONS, D, rows
from tidemark.operators import duplicate_matches, insert_absent, merge, upsert
from tidemark.sources import stage

COLUMNS = "a bigint, b string, v bigint"
TARGET = COLUMNS + ", " + AUDIT
PLANS = ["probe", "outer", "split"]


def merged(spark, stored, new, keys=("a",), plan="auto"):
    target = spark.createDataFrame([(*r, *OLD) for r in stored], TARGET)
    source = spark.createDataFrame(new, COLUMNS)
    return rows(upsert(target, source, list(keys), "L1", LOAD_AT, plan=plan))


@pytest.mark.parametrize("plan", PLANS)
def test_matches_are_overwritten_new_rows_added_others_kept(spark, plan):
    got = merged(spark, [(1, "x", 1), (2, "y", 2), (3, "z", 3)], [(2, "y", 20), (3, "z", 3), (4, None, None)], plan=plan)
    assert got == Counter([(1, "x", 1, *OLD), (2, "y", 20, *UPDATED), (3, "z", 3, *UPDATED), (4, None, None, *NEW)])


@pytest.mark.parametrize("plan", PLANS)
def test_null_keys_never_match(spark, plan):
    got = merged(spark, [(None, "x", 1), (1, "x", 1)], [(None, "x", 2), (None, "x", 2), (1, "x", 5)], plan=plan)
    assert got == Counter({(None, "x", 1, *OLD): 1, (None, "x", 2, *NEW): 2, (1, "x", 5, *UPDATED): 1})


@pytest.mark.parametrize("plan", PLANS)
def test_composite_key_needs_every_part(spark, plan):
    got = merged(spark, [(1, "x", 1), (1, None, 2)], [(1, "y", 3), (1, "x", 4), (1, None, 5)], ["a", "b"], plan)
    assert got == Counter([(1, "x", 4, *UPDATED), (1, None, 2, *OLD), (1, "y", 3, *NEW), (1, None, 5, *NEW)])


@pytest.mark.parametrize("plan", PLANS)
def test_empty_sides(spark, plan):
    assert merged(spark, [], [(1, "x", 1)], plan=plan) == Counter([(1, "x", 1, *NEW)])
    assert merged(spark, [(1, "x", 1)], [], plan=plan) == Counter([(1, "x", 1, *OLD)])


@pytest.mark.parametrize("plan", PLANS)
def test_a_null_value_overwrites(spark, plan):
    assert merged(spark, [(1, "x", 1)], [(1, None, None)], plan=plan) == Counter([(1, None, None, *UPDATED)])


@pytest.mark.parametrize("plan", PLANS)
def test_copies_of_a_new_key_all_go_in_and_stored_copies_are_all_updated(spark, plan):
    got = merged(spark, [(1, "x", 1), (1, "y", 2)], [(2, "n", 1), (2, "n", 2), (1, "z", 9)], plan=plan)
    assert got == Counter({(2, "n", 1, *NEW): 1, (2, "n", 2, *NEW): 1, (1, "z", 9, *UPDATED): 2})


def test_source_is_cast_to_the_target_and_extra_columns_are_left_out(spark):
    target = spark.createDataFrame([], TARGET)
    source = spark.createDataFrame([("7", 8, "8", "more")], "a string, b int, v string, extra string")
    assert rows(upsert(target, source, ["a"], "L1", LOAD_AT)) == Counter([(7, "8", 8, *NEW)])


def test_merging_twice_changes_only_audit_values(spark):
    target = spark.createDataFrame([(1, "x", 1, *OLD), (2, "y", 2, *OLD)], TARGET)
    source = spark.createDataFrame([(2, "y", 5), (3, "z", 3)], COLUMNS)
    once = upsert(target, source, ["a"], "L1", LOAD_AT)
    twice = upsert(once, source, ["a"], "L2", LOAD_AT)
    business = ["a", "b", "v"]
    assert rows(once.select(business)) == rows(twice.select(business))


def test_the_plan_follows_sizes_and_copies(spark):
    target = spark.createDataFrame([(1, "x", 1, *OLD)], TARGET)
    source = stage(spark.createDataFrame([(1, "x", 2)], COLUMNS), "small")

    def joins(**more):
        text = upsert(target, source, ["a"], "L1", LOAD_AT, **more)._jdf.queryExecution().optimizedPlan().toString()
        return [j for j in ("LeftSemi", "LeftAnti", "LeftOuter", "FullOuter") if j in text]

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        assert joins() == joins(many_copies=True) == ["LeftSemi", "LeftAnti", "LeftOuter"]
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert joins() == ["FullOuter"]
        assert joins(many_copies=True) == ["LeftAnti", "LeftOuter"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_unknown_plan_is_refused(spark):
    target = spark.createDataFrame([], TARGET)
    with pytest.raises(ValueError):
        upsert(target, target, ["a"], "L1", LOAD_AT, plan="none")


def test_duplicate_matches_name_only_ambiguous_updates(spark):
    target = spark.createDataFrame([(1, "x", 1, *OLD), (2, "y", 2, *OLD), (None, "n", 0, *OLD)], TARGET)
    source = spark.createDataFrame(
        [(1, "a", 1), (1, "b", 2), (2, "c", 3), (3, "d", 4), (3, "e", 5), (None, "f", 6), (None, "g", 7)], COLUMNS
    )
    assert rows(duplicate_matches(target, source, ["a"])) == Counter([(1, 2)])


def row_by_row(stored, new):
    """Brute force: what a row-by-row merge on column ``a`` leaves behind."""
    out = []
    for row in stored:
        hit = [s for s in new if s[0] is not None and s[0] == row[0]]
        out += [(*s, *UPDATED) for s in hit] or [(*row, *OLD)]
    known = {r[0] for r in stored}
    return Counter(out + [(*s, *NEW) for s in new if s[0] is None or s[0] not in known])


key = st.one_of(st.none(), st.integers(0, 6))
some_rows = st.lists(st.tuples(key, st.sampled_from(["x", "y", None]), st.integers(0, 3)), max_size=8)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(stored=some_rows, new=some_rows)
def test_all_plans_agree_with_brute_force(spark, stored, new):
    unique, seen = [], set()
    for row in new:
        if row[0] is None or row[0] not in seen:
            unique.append(row)
            seen.add(row[0])
    want = row_by_row(stored, unique)
    for plan in PLANS:
        assert merged(spark, stored, unique, plan=plan) == want


def merged_beside(spark, stored, new, among=None):
    target = spark.createDataFrame([(*r, *OLD) for r in stored], TARGET)
    source = spark.createDataFrame(new, COLUMNS)
    among = spark.createDataFrame(among, COLUMNS) if among is not None else None
    return rows(upsert(target, source, ["a"], "L1", LOAD_AT, plan="outer", beside="b", among=among))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(stored=some_rows, new=some_rows)
def test_merging_beside_a_column_agrees_with_brute_force(spark, stored, new):
    """Keys repeat on both sides, move to another value of the column, or have none."""
    assert merged_beside(spark, stored, new) == row_by_row(stored, new)


def test_a_key_that_moved_is_still_a_match(spark):
    stored, new = [(1, "x", 1), (2, "x", 2), (3, None, 3)], [(1, "y", 4), (2, "x", 5), (3, "z", 6), (4, "z", 7)]
    want = Counter([(1, "y", 4, *UPDATED), (2, "x", 5, *UPDATED), (3, "z", 6, *UPDATED), (4, "z", 7, *NEW)])
    assert merged_beside(spark, stored, new) == want
    more = [(9, "x", 0), (9, "y", 0), (None, "x", 0), (None, "y", 0)]
    assert merged_beside(spark, stored, new, stored + new + more) == want


def test_a_crowded_value_is_merged_apart(spark, monkeypatch):
    monkeypatch.setattr(merge, "CROWD", 3)
    stored = [(i, "x", i) for i in range(6)] + [(7, "y", 7), (7, "y", 8)]
    new = [(i, "x", 10 * i) for i in range(3, 9) if i != 7] + [(7, "y", 70), (9, "y", 9), (9, "y", 10)]
    assert merged_beside(spark, stored, new) == row_by_row(stored, new)


def test_facts_are_merged_where_the_join_by_order_left_them(spark, tmp_path):
    orders = spark.range(20).selectExpr("id order_id", "id % 7 customer", "'O' status")
    spark.range(100).selectExpr("id % 20 order_id", "id v").write.parquet(f"{tmp_path}/items")
    items = spark.read.parquet(f"{tmp_path}/items").selectExpr("concat_ws('-', v, order_id) item", "*")
    stamp = [F.expr(f"cast('{v}' as {kind}) {c}") for c, kind, v in (
        ("dw_create_dt", "timestamp_ntz", "2024-01-01"), ("dw_mdfctn_dt", "timestamp_ntz", "2024-01-01"),
        ("dw_load_id", "string", "L0"), ("dw_update_id", "string", "L0"))]
    target = items.where("v < 60").withColumn("v", -F.col("v")).join(orders, "order_id").select("*", *stamp)
    source = items.where("v >= 30").join(orders, "order_id")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        state = upsert(target, source, ["item"], "L1", LOAD_AT, beside="order_id", among=items)
        plan = state._jdf.queryExecution().executedPlan().toString()
        shuffles = [line for line in plan.splitlines() if "Exchange " in line]
        # Items and orders on either side, and the merge needs none.
        assert len(shuffles) == 4 and all("hashpartitioning(order_id#" in line for line in shuffles)
        assert rows(state) == rows(upsert(target, source, ["item"], "L1", LOAD_AT, plan="outer"))
        assert state.where("v >= 30 and dw_load_id = 'L0'").count() == 30 and state.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


DIMENSION = "id bigint, mdfctn_dt timestamp_ntz, sk bigint, " + VERSIONS


def test_insert_absent_adds_only_keys_without_an_open_version(spark):
    day, end = D("2024-01-05"), D("2024-01-20")
    was_open, was_closed = (*OLD, day, None), (*OLD, day, D("2024-01-10"))
    target = spark.createDataFrame(
        [(1, day, 1, *was_open), (2, day, 2, *was_closed), (None, day, 3, *was_open)], DIMENSION
    )
    source = spark.createDataFrame(
        [(1, D("2024-01-15")), (2, D("2024-01-15")), (3, day), (None, day)], "id bigint, mdfctn_dt timestamp_ntz"
    )
    got = rows(insert_absent(target, source, ["id"], end, "L1", LOAD_AT, surrogate="sk"))
    added = (*NEW, end, None)
    assert got == Counter(
        [
            (1, day, 1, *was_open),
            (2, day, 2, *was_closed),
            (None, day, 3, *was_open),
            (2, D("2024-01-15"), None, *added),
            (3, day, None, *added),
            (None, day, None, *added),
        ]
    )
