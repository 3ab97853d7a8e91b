"""Surrogate keys without a single-partition window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# One short row per file: some megabytes at this many.
BROADCAST_FILES = 20_000


def number_rows(stored: DataFrame, column: str, after: int) -> DataFrame:
    """Number the rows of a parquet-backed frame ``after + 1, after + 2, ...`` with no gaps.

    ``stored`` must scan files already written: the number is the row's place in its file plus the
    rows of the files before it, so it is the same on every retry. Only one count per file goes
    through the window; the rows themselves are not sorted, and are not shuffled either unless there
    are more files than are worth broadcasting a number for.
    """
    placed = stored.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    sizes = stored.select(F.col("_metadata.file_path").alias("__file")).groupBy("__file").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__file", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    if len(stored.inputFiles()) <= BROADCAST_FILES:
        offsets = F.broadcast(offsets)
    return (
        placed.join(offsets, "__file")
        .withColumn(column, F.lit(after) + F.col("__before") + F.col("__row") + 1)
        .select(column, *stored.columns)
    )
