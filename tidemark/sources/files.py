"""Delimited extracts and the parquet snapshots made from them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions.literals import as_moment


def read_csv(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, ragged: str | None = None, header: bool = True
) -> DataFrame:
    """A CSV extract, every column as text; no types are inferred.

    Without ``columns`` the header row names them. Given, no job is spent on reading it first, and
    Spark checks that the header names the same columns in the same order.

    A line with a field too many loses it and a line with too few gets NULLs, without a word. ``ragged``
    names a further column that holds the whole line in these cases, and NULL for lines that fit.
    """
    if columns is None:
        named = spark.read.option("header", True).csv(path)
        if ragged is None:
            return named
        columns = named.columns
    text = StructType([StructField(c, StringType()) for c in columns])
    reader = spark.read.option("header", header).option("enforceSchema", not header)
    if ragged is not None:
        text = text.add(ragged, StringType())
        # Fields are only counted where none is skipped.
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", ragged).option("columnPruning", False)
    return reader.schema(text).csv(path)


def snapshot_path(root: str, name: str, load_end: datetime | str) -> str:
    """One directory per extract and day of the load's end, so a repeated load replaces its own."""
    return f"{root.rstrip('/')}/landing_files/{name}/{as_moment(load_end).date()}"


def write_snapshot(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
