"""Runs and their tasks, kept as a log of events: the last event of a task is its state.

Both reductions are combined per task before the shuffle, so a job with very many runs is no hot spot. What
is kept per group is a struct, which Spark aggregates by sorting, so every task sorts its rows first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_log_current(events: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The last event per key, by ``order_by`` (which should settle ties)."""
    rest = [c for c in events.columns if c not in keys]
    return (
        events.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order_by)).alias("__last"))
        .select(*[F.col(c) if c in keys else F.col(f"__last.{c}").alias(c) for c in events.columns])
    )


def latest_run(
    runs: DataFrame, job: str = "job_name", ended: str = "wf_end_datetime", ties: Sequence[str] = ("job_exec_id",)
) -> DataFrame:
    """The run of each job that ended last. One still open counts only if none has ended."""
    # Structs compare field by field and a NULL is lowest.
    return run_log_current(runs, [job], [ended, *ties])
