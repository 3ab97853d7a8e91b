from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from tests.frames import D, rows
from tidemark.functions import conform, number_rows
from tidemark.sources import Tables, read_csv, read_snapshot, shared_folder, stage, write_snapshot
from tidemark.sources.files import snapshot_path
from tidemark.sources.tables import NONE, Conflict, by_day, by_month

SCHEMA = StructType(
    [StructField("k", LongType()), StructField("v", StringType()), StructField("at", TimestampNTZType())]
)


@pytest.fixture
def tables(spark, tmp_path):
    return Tables(spark, str(tmp_path))


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


A, B, C = (1, "a", D("2024-01-05")), (2, "b", D("2024-01-20")), (3, "c", D("2024-02-01"))


def test_a_table_starts_empty_and_holds_its_last_version(spark, tables):
    tables.create("x/t", SCHEMA)
    assert tables.exists("x/t") and not tables.exists("x/u")
    assert tables.read("x/t").schema == SCHEMA and tables.read("x/t").isEmpty()
    tables.write("x/t", frame(spark, A, B))
    first = tables.read("x/t")
    tables.write("x/t", frame(spark, C))
    assert rows(tables.read("x/t")) == Counter([C])
    assert rows(first) == Counter([A, B])  # a reader keeps the version it began with
    tables.append("x/t", frame(spark, A))
    assert rows(tables.read("x/t")) == Counter([A, C])


def test_a_table_can_be_rewritten_from_itself(spark, tables):
    tables.create("t", SCHEMA)
    tables.write("t", frame(spark, A, B))
    tables.write("t", tables.read("t").withColumn("k", F.col("k") + 1))
    assert sorted(r.k for r in tables.read("t").collect()) == [2, 3]


def test_only_named_slices_are_replaced(spark, tables):
    tables.create("t", SCHEMA, layout=by_month("at"))
    odd = (9, "odd", None)
    tables.write("t", frame(spark, A, B, C, odd))
    files = {p for p in tables.read("t", {"2024-02"}).inputFiles()}
    tables.write("t", frame(spark, (1, "new", A[2])), replace={"2024-01"})
    assert rows(tables.read("t")) == Counter([(1, "new", A[2]), C, odd])
    assert set(tables.read("t", {"2024-02"}).inputFiles()) == files
    assert rows(tables.read("t", {NONE})) == Counter([odd])
    # Rows of a slice that is not named come on top; a named slice without rows is gone.
    tables.write("t", frame(spark, (4, "d", C[2])), replace={"2024-01"})
    assert rows(tables.read("t")) == Counter([C, (4, "d", C[2]), odd])
    assert {r.dw_slice for r in tables.read_sliced("t").collect()} == {"2024-02", NONE}


def test_a_layout_is_one_of_few(spark, tables):
    for wrong in ("v", "date_format(at, 'yyyy')", "month:", "year:at"):
        with pytest.raises(ValueError):
            tables.create("t", SCHEMA, layout=wrong)


def test_rows_without_a_slice_value_lie_in_a_slice_of_their_own(spark, tables):
    text = StructType([StructField("k", LongType()), StructField("at", StringType())])
    tables.create("t", text, layout=by_day("at"))
    some = spark.createDataFrame([(1, None), (2, "2024-01-05")], text)
    tables.write("t", some)
    assert {r.dw_slice for r in tables.read_sliced("t").collect()} == {NONE, "2024-01-05"}
    tables.write("t", some, replace={NONE, "2024-01-05"})
    assert rows(tables.read("t")) == rows(some)
    empty = spark.createDataFrame([("",), (None,), ("x",)], "v string").select(F.coalesce(F.nullif("v", F.lit("")), F.lit(NONE)))
    assert sorted(r[0] for r in empty.collect()) == [NONE, NONE, "x"]


@pytest.mark.parametrize("wrong", ["2023-12", None, ""])
def test_slices_that_a_table_cannot_have_are_refused(spark, tables, wrong):
    tables.create("t", SCHEMA, layout=by_month("at"))
    tables.write("t", frame(spark, A))
    for call in (lambda: tables.write("t", frame(spark, B), replace={wrong}), lambda: tables.read("t", {wrong})):
        with pytest.raises(ValueError):
            call()
    assert rows(tables.read("t")) == Counter([A])


def test_of_two_writers_of_one_version_the_second_fails(spark, tables):
    tables.create("t", SCHEMA)
    with pytest.raises(Conflict):
        tables.create("t", SCHEMA)
    other = Tables(spark, tables.root)
    seen = tables.version("t")
    other.write("t", frame(spark, A))
    with pytest.raises(Conflict):
        tables.write("t", frame(spark, B), based_on=seen)
    assert rows(tables.read("t")) == Counter([A])


def test_an_update_is_made_again_if_another_writer_was_first(spark, tables):
    tables.create("t", SCHEMA)
    other, tries = Tables(spark, tables.root), []

    def change(df):
        if not tries:
            other.append("t", frame(spark, A))
        tries.append(1)
        return df.unionByName(frame(spark, B))

    tables.update("t", change)
    assert len(tries) == 2 and rows(tables.read("t")) == Counter([A, B])


def test_many_events_lie_in_few_directories(spark, tables):
    tables.create("t", SCHEMA)
    for i in range(50):
        tables.update("t", lambda df, i=i: df.unionByName(frame(spark, (i, "e", None))))
    assert sorted(r.k for r in tables.read("t").collect()) == list(range(50))
    assert len({p.rsplit("/", 1)[0] for p in tables.read("t").inputFiles()}) == 1
    assert len(tables._seen) == 1


def test_compacting_changes_files_and_no_rows(spark, tables):
    tables.create("t", SCHEMA, layout=by_month("at"))
    for row in (A, B, C):
        tables.append("t", frame(spark, row))
    folders = lambda: len({p.rsplit("/", 1)[0] for p in tables.read("t", {"2024-01"}).inputFiles()})
    assert folders() == 2
    kept = set(tables.read("t", {"2024-02"}).inputFiles())
    tables.compact("t", {"2024-01"})
    assert folders() == 1 and rows(tables.read("t")) == Counter([A, B, C])
    assert set(tables.read("t", {"2024-02"}).inputFiles()) == kept


def test_a_write_that_died_half_way_is_neither_seen_nor_in_the_way(spark, tables, monkeypatch):
    tables.create("t", SCHEMA)
    tables.write("t", frame(spark, A))
    with monkeypatch.context() as patch:
        patch.setattr(tables, "_commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            tables.write("t", frame(spark, B))
    assert rows(tables.read("t")) == Counter([A])
    tables.write("t", frame(spark, C))
    assert rows(Tables(spark, tables.root).read("t")) == Counter([C])


def test_reading_a_missing_table_is_an_error(tables):
    with pytest.raises(ValueError):
        tables.read("nothing")


def test_csv_is_text_with_quotes_and_empty_fields(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('k,v,at\n1,"a, b",2024-01-05 00:00:00\n2,,soon\nx,c,\n')
    text = read_csv(spark, str(path), ["k", "v", "at"])
    assert text.dtypes == [("k", "string"), ("v", "string"), ("at", "string")]
    assert rows(text) == rows(read_csv(spark, str(path)))
    typed, rejected = conform(text, SCHEMA)
    assert rows(typed) == Counter([(1, "a, b", D("2024-01-05"))])
    assert rows(rejected) == Counter([("2", None, "soon"), ("x", "c", None)])


def test_csv_with_other_columns_than_declared_fails(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("k,w\n1,a\n")
    with pytest.raises(Exception):
        read_csv(spark, str(path), ["k", "v"]).collect()


def test_a_snapshot_of_the_same_day_is_replaced(spark, tmp_path):
    path = snapshot_path(str(tmp_path), "t", "2024-01-05 23:59:59")
    assert path.endswith("landing_files/t/2024-01-05")
    write_snapshot(frame(spark, A, B), path)
    write_snapshot(frame(spark, C), path)
    assert rows(read_snapshot(spark, path)) == Counter([C])


def test_staged_rows_lie_in_the_folder_the_session_names(spark):
    staged = stage(frame(spark, A, B), "some")
    assert rows(staged) == Counter([A, B])
    assert all(f.startswith(shared_folder(spark).replace("file:", "file://")) for f in staged.inputFiles())
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_surrogates_are_dense_stable_and_unique(spark):
    stored = stage(spark.range(0, 1000, 1, 7).selectExpr("id", "'x' as v"), "numbered")
    numbered = number_rows(stored, "sk", 41)
    got = {r.id: r.sk for r in numbered.collect()}
    assert sorted(got.values()) == list(range(42, 1042))
    assert {r.id: r.sk for r in numbered.repartition(3).collect()} == got
    assert numbered.columns == ["sk", "id", "v"]
