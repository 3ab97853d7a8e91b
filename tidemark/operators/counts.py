"""What a load did, read off the audit columns in one pass."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.literals import as_moment, ts_literal, whole_days


def load_counts(df: DataFrame, load_id: str, load_ts: datetime | str) -> DataFrame:
    """One row: rows modified that day by any run, inserted by this one, updated by this one,
    and written by this run at this instant. Only three audit columns are read, and of these only
    the parts that can hold such rows: the filter reaches the scan."""
    dtype = df.schema["dw_mdfctn_dt"].dataType
    at = as_moment(load_ts)
    that_day = whole_days("dw_mdfctn_dt", dtype, at, at)
    mine, updated = F.col("dw_load_id") == load_id, F.col("dw_update_id") == load_id
    return df.where(that_day | mine | updated).agg(
        F.count_if(that_day).alias("target_count"),
        F.count_if(mine).alias("insert_count"),
        F.count_if(updated).alias("update_count"),
        F.count_if(F.col("dw_mdfctn_dt") == ts_literal(at, dtype)).alias("written_count"),
    )
