"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from checks.oracle import ORACLE
from checks.registry import QUERIES

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
NAMES = ["part", "orders", "lineitem", "customer", "events", "nation", "supplier", "region"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_sql(spark, duck, key):
    ours = entry.queries()[key](spark, SF)
    theirs = duck.execute(entry.oracle_sql()[key])
    names = [d[0] for d in theirs.description]
    assert sorted(ours.columns) == sorted(names)
    got, want = _rows(ours.columns, ours.collect()), _rows(names, theirs.fetchall())
    assert sum(got.values()) > 0
    assert (got - want, want - got) == (Counter(), Counter())
