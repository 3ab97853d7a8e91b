"""The control tables as DataFrames: what is due, up to when, and how it ended.

Three-valued flags: "is true" and "is false" never hold for a NULL, so each test is null-safe.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.literals import as_moment, ts_literal
from tidemark.operators.updates import keyed_update, update_from

# Layers, states and messages as the control tables hold them.
LAYERS = ("landing", "bronze", "silver", "gold")
STARTED, SUCCESS, FAILED = "Started", "Success", "Failed"
IN_PROGRESS = "In Progress"
RUN_DONE = "Workflow completed successfully."
RUN_UNPROCESSED = "Listed tables remained unprocessed: '{}'"
RUN_HAS_UNPROCESSED = "There are unprocessed tables in the cntrl_stm_mapping table."
RUN_HAS_FAILURES = "There are failed jobs in the batch, Please check the logs."


def is_true(name: str) -> Column:
    return F.col(name).eqNullSafe(True)


def is_false(name: str) -> Column:
    return F.col(name).eqNullSafe(False)


def live() -> Column:
    return is_true("active_flag") & is_false("is_delete_flag")


def pending(control: DataFrame, layer: str | None = None) -> DataFrame:
    """Tables a load should take up, in one layer or in all.

    Landing asks for active, undeleted and unprocessed. Bronze does not look at the delete mark.
    Silver and gold stop only at a table that is marked processed or marked inactive.
    """
    strict = is_false("is_processed_flag") & is_true("active_flag")
    name = F.col("target_layer_name")
    due = (
        F.when(name == "landing", strict & is_false("is_delete_flag"))
        .when(name == "bronze", strict)
        .otherwise(~is_true("is_processed_flag") & ~is_false("active_flag"))
    )
    return control.where(due if layer is None else due & (name == layer))


def pending_landing(control: DataFrame) -> DataFrame:
    """Landing tables due, each with the bronze table that reads it."""
    bronze = control.where(F.col("target_layer_name") == "bronze").select(
        F.col("table_id").alias("bronze_table_id"),
        F.col("target_table_name").alias("bronze_table_name"),
        F.col("source_table_name").alias("__from"),
    )
    due = pending(control, "landing")
    return due.join(bronze, F.col("target_table_name") == F.col("__from"), "inner").select(
        "bronze_table_id", "bronze_table_name", *due.columns
    )


def advance_window(
    control: DataFrame,
    layers: Sequence[str],
    now: datetime | str,
    load_id: str,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
) -> DataFrame:
    """Open the next window of the live tables in ``layers`` and mark them unprocessed.

    It starts where the last one ended and ends a second before today, unless given.
    """
    dtype = control.schema["last_load_end_dt"].dataType
    cutoff = as_moment(now).replace(hour=0, minute=0, second=0, microsecond=0) - timedelta(seconds=1)
    return keyed_update(
        control,
        F.col("target_layer_name").isin(list(layers)) & live(),
        {
            "last_load_start_dt": F.col("last_load_end_dt") if start is None else ts_literal(start, dtype),
            "last_load_end_dt": ts_literal(cutoff if end is None else end, dtype),
            "is_processed_flag": False,
            "dw_mdfctn_dt": ts_literal(now, control.schema["dw_mdfctn_dt"].dataType),
            "dw_load_id": load_id,
        },
    )


def unprocessed(control: DataFrame, layers: Sequence[str] | None = None) -> DataFrame:
    """Live tables still to do."""
    left = control.where(live() & is_false("is_processed_flag"))
    return left if layers is None else left.where(F.col("target_layer_name").isin(list(layers)))


def unprocessed_names(control: DataFrame, layers: Sequence[str] | None = None) -> DataFrame:
    """Per layer, how many tables are still to do and which. One name per control row, so a short text."""
    return (
        unprocessed(control, layers)
        .groupBy("target_layer_name")
        .agg(
            F.count("*").alias("table_count"),
            F.array_join(F.sort_array(F.collect_list("target_table_name")), ", ").alias("table_names"),
        )
    )


def load_range(control: DataFrame) -> DataFrame:
    """The latest window bounds among live, processed tables; one row."""
    return control.where(live() & is_true("is_processed_flag")).agg(
        F.max("last_load_start_dt").alias("load_start"), F.max("last_load_end_dt").alias("load_end")
    )


def run_outcome(control: DataFrame, layers: Sequence[str] | None = None) -> DataFrame:
    """How a run over ``layers`` (all, if None) ended; one row.

    With tables left over: failed, their names in the message, no window. Otherwise success and the
    window loaded. One pass over the control table.
    """
    in_scope = F.lit(True) if layers is None else F.col("target_layer_name").isin(list(layers))
    left = in_scope & live() & is_false("is_processed_flag")
    done = live() & is_true("is_processed_flag")
    seen = control.agg(
        F.array_join(F.sort_array(F.collect_list(F.when(left, F.col("target_table_name")))), ", ").alias("names"),
        F.count_if(left).alias("table_count"),
        F.max(F.when(done, F.col("last_load_start_dt"))).alias("load_start"),
        F.max(F.when(done, F.col("last_load_end_dt"))).alias("load_end"),
    )
    failed = F.col("table_count") > 0
    before, after = RUN_UNPROCESSED.split("{}")
    return seen.select(
        F.when(failed, FAILED).otherwise(SUCCESS).alias("exec_status"),
        F.when(failed, F.concat(F.lit(before), F.col("names"), F.lit(after))).otherwise(RUN_DONE).alias("status_message"),
        F.when(~failed, F.col("load_start")).alias("data_load_start_dt"),
        F.when(~failed, F.col("load_end")).alias("data_load_end_dt"),
    )


def failure_message(control: DataFrame) -> str:
    """What the failure handler reports. Runs a job on the control table."""
    return RUN_HAS_FAILURES if unprocessed(control).isEmpty() else RUN_HAS_UNPROCESSED


def due_files(registry: DataFrame) -> DataFrame:
    return registry.where(is_false("is_processed_flag"))


def pick_files(registry: DataFrame, control: DataFrame) -> DataFrame:
    """Per pending bronze table, the unprocessed snapshot of exactly its window's end.

    The table stays with a NULL path where there is none. Of several, the first path in order counts;
    the minimum of a text is combined before its shuffle, by a sort in every task.
    """
    due = pending(control, "bronze").select("table_id", "target_table_name", "last_load_end_dt")
    files = (
        due_files(registry)
        .groupBy("table_id", F.col("delta_load_dt").alias("last_load_end_dt"))
        .agg(F.min("file_path").alias("file_path"))
    )
    return due.join(files, ["table_id", "last_load_end_dt"], "left_outer").select(
        "table_id", "target_table_name", "last_load_end_dt", "file_path"
    )


def register_files(registry: DataFrame, written: DataFrame, now: datetime | str, load_id: str) -> DataFrame:
    """Point registry rows at new snapshots: ``written(table_id, file_path, delta_load_dt)``.

    A table without a registry row stays without one.
    """
    updates = written.select(
        "table_id",
        "file_path",
        "delta_load_dt",
        ts_literal(now, registry.schema["file_create_dt"].dataType).alias("file_create_dt"),
        F.lit(False).alias("is_processed_flag"),
        F.lit(load_id).alias("dw_load_id"),
    )
    return update_from(registry, updates, ["table_id"], updates.columns[1:])
