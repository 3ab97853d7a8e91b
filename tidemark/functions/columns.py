"""Which columns are keys, business values or audit values, and how audit values are set."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.literals import ts_literal

# The audit column names every loaded table carries.
SCD1_AUDIT = ("dw_create_dt", "dw_mdfctn_dt", "dw_load_id", "dw_update_id")
SCD2_AUDIT = SCD1_AUDIT + ("dw_eff_start_dt", "dw_eff_end_dt")


def business_columns(df: DataFrame, surrogate: str | None = None) -> list[str]:
    """Columns a source row supplies: everything but audit values and the surrogate key."""
    own = {*SCD2_AUDIT, surrogate}
    return [c for c in df.columns if c not in own]


def insert_stamp(target: DataFrame, load_id: str, load_ts: datetime, eff_ts: datetime | None = None) -> dict[str, Column]:
    """Audit values of a new row, typed as in ``target``."""
    types = {f.name: f.dataType for f in target.schema.fields}
    values = {
        "dw_create_dt": ts_literal(load_ts, types["dw_create_dt"]),
        "dw_mdfctn_dt": ts_literal(load_ts, types["dw_mdfctn_dt"]),
        "dw_load_id": F.lit(load_id).cast(types["dw_load_id"]),
        "dw_update_id": F.lit(None).cast(types["dw_update_id"]),
    }
    if eff_ts is not None:
        values["dw_eff_start_dt"] = ts_literal(eff_ts, types["dw_eff_start_dt"])
        values["dw_eff_end_dt"] = F.lit(None).cast(types["dw_eff_end_dt"])
    return values


def keys_present(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def split_on_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """(rows whose keys are all set, rows with a NULL in a key).

    A NULL key never matches, so such rows need no join. Left in, they would all hash to one
    shuffle partition, however many there are. The second part is None when the schema rules
    NULL keys out; on parquet its ``IS NULL`` filter is answered mostly from row-group statistics.
    """
    nullable = [k for k in keys if df.schema[k].nullable]
    if not nullable:
        return df, None
    whole = keys_present(nullable)
    return df.where(whole), df.where(~whole)
