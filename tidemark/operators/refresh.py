"""Replace the slices of an aggregate that a change touched; keep the others as they are."""

from __future__ import annotations

from pyspark.sql import DataFrame


def drop_slices(target: DataFrame, slices: DataFrame, column: str) -> DataFrame:
    """Rows of ``target`` whose ``column`` is not in ``slices``; a NULL is in no slice and stays."""
    return target.join(slices.select(column), column, "left_anti").select(*target.columns)


def refresh_slices(target: DataFrame, recomputed: DataFrame, slices: DataFrame, column: str) -> DataFrame:
    """Delete the slices and insert their recomputed rows, in one plan.

    ``slices`` is joined, never collected, so it may be as long as the table has slices.
    """
    return drop_slices(target, slices, column).unionByName(recomputed.select(*target.columns))
