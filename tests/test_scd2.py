from __future__ import annotations

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.frames import LOAD_AT, NEW, OLD, UPDATED, VERSIONS, D, rows
from tidemark.operators import apply_scd2, open_versions
from tidemark.sources import stage

TARGET = "id bigint, v string, mdfctn_dt timestamp_ntz, " + VERSIONS
SOURCE = "id bigint, v string, mdfctn_dt timestamp_ntz"
T0, T1, END = D("2024-01-05"), D("2024-01-06"), D("2024-01-20")
OPEN = (*OLD, T0, None)
CLOSED = (*OLD, T0, D("2024-01-10"))
EXPIRED = (*UPDATED, T0, END)
ADDED = (*NEW, END, None)


def applied(spark, target, source):
    frames = spark.createDataFrame(target, TARGET), spark.createDataFrame(source, SOURCE)
    found = apply_scd2(*frames, ["id"], END, "L1", LOAD_AT)
    assert rows(apply_scd2(*frames, ["id"], END, "L1", LOAD_AT, one_pass=True)) == rows(found)
    return found


def test_every_kind_of_row(spark):
    target = [
        (1, "a", T0, *OPEN),
        (2, "a", T0, *OPEN),
        (3, "a", None, *OPEN),
        (4, "a", T0, *OPEN),
        (5, "a", T0, *CLOSED),
        (6, "z", T0, *CLOSED),
        (6, "a", T0, *OPEN),
        (7, "a", T0, *OPEN),
        (None, "a", T0, *OPEN),
    ]
    source = [
        (1, "b", T1),
        (2, "b", T0),
        (3, "b", T1),
        (4, "b", None),
        (5, "b", T0),
        (6, "b", T1),
        (8, "b", T1),
        (None, "b", T1),
    ]
    assert rows(applied(spark, target, source)) == Counter(
        [
            (1, "a", T0, *EXPIRED),
            (1, "b", T1, *ADDED),
            (2, "a", T0, *OPEN),
            (3, "a", None, *OPEN),
            (4, "a", T0, *OPEN),
            (5, "a", T0, *CLOSED),
            (5, "b", T0, *ADDED),
            (6, "z", T0, *CLOSED),
            (6, "a", T0, *EXPIRED),
            (6, "b", T1, *ADDED),
            (7, "a", T0, *OPEN),
            (8, "b", T1, *ADDED),
            (None, "a", T0, *OPEN),
            (None, "b", T1, *ADDED),
        ]
    )


def test_empty_sides(spark):
    assert rows(applied(spark, [], [(1, "b", T1)])) == Counter([(1, "b", T1, *ADDED)])
    assert rows(applied(spark, [(1, "a", T0, *OPEN)], [])) == Counter([(1, "a", T0, *OPEN)])


def test_same_load_again_changes_nothing(spark):
    target = [(1, "a", T0, *OPEN), (2, "a", T0, *OPEN)]
    source = [(1, "b", T1), (3, "b", T1)]
    once = applied(spark, target, source)
    again = apply_scd2(once, spark.createDataFrame(source, SOURCE), ["id"], END, "L2", LOAD_AT)
    assert rows(once) == rows(again)


times = st.one_of(st.none(), st.sampled_from([T0, T1]))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    stored=st.dictionaries(st.integers(0, 5), st.tuples(times, st.booleans()), max_size=6),
    new=st.dictionaries(st.integers(0, 7), times, max_size=7),
)
def test_one_open_version_per_key_and_versions_abut(spark, stored, new):
    target = [(k, "a", t, *(OPEN if is_open else CLOSED)) for k, (t, is_open) in stored.items()]
    after = applied(spark, target, [(k, "b", t) for k, t in new.items()])
    opened = Counter(r.id for r in open_versions(after).collect())
    assert set(opened.values()) <= {1}
    assert set(opened) == {k for k, (_, is_open) in stored.items() if is_open} | set(new)
    history = after.collect()
    for row in history:
        if row.dw_update_id == "L1":
            assert [r.dw_eff_start_dt for r in history if r.id == row.id and r.dw_load_id == "L1"] == [row.dw_eff_end_dt]


def test_the_join_probes_a_small_change_set_and_never_touches_closed_versions(spark, tmp_path):
    path = str(tmp_path / "dim")
    spark.createDataFrame([(1, "a", T0, *OPEN), (1, "z", T0, *CLOSED)], TARGET).write.parquet(path)
    source = spark.createDataFrame([(1, "b", T1)], SOURCE)
    after = apply_scd2(spark.read.parquet(path), source, ["id"], END, "L1", LOAD_AT)
    assert after.count() == 3
    closed_part = after._jdf.queryExecution().optimizedPlan().children().head().toString()
    assert "Join" not in closed_part and "isnotnull(dw_eff_end_dt" in closed_part


def test_one_pass_shuffles_either_side_once(spark):
    target = stage(spark.createDataFrame([(i, "a", T0, *OPEN) for i in range(50)], TARGET), "versions")
    source = stage(spark.createDataFrame([(i, "b", T1) for i in range(40, 60)], SOURCE), "changes")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [apply_scd2(target, source, ["id"], END, "L1", LOAD_AT, one_pass=x) for x in (True, False)]
        texts = [p._jdf.queryExecution().executedPlan().toString() for p in plans]
        found = rows(plans[0])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The union of both is what is shuffled.
    assert texts[0].count("Exchange hashpartitioning(id") == 1 and "Join" not in texts[0]
    assert texts[1].count("Exchange hashpartitioning(id") > 2
    assert sum(found.values()) == 50 + 20
