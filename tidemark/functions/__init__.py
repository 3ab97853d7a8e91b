"""Column-level helpers shared by the operators."""

from tidemark.functions.columns import (
    SCD1_AUDIT,
    SCD2_AUDIT,
    business_columns,
    insert_stamp,
    keys_present,
    split_on_keys,
)
from tidemark.functions.literals import closed_range, ts_literal, whole_days
from tidemark.functions.sizes import below_broadcast_threshold
from tidemark.functions.surrogate import number_rows
from tidemark.functions.typing import conform

__all__ = [
    "SCD1_AUDIT",
    "SCD2_AUDIT",
    "below_broadcast_threshold",
    "business_columns",
    "closed_range",
    "conform",
    "insert_stamp",
    "keys_present",
    "number_rows",
    "split_on_keys",
    "ts_literal",
    "whole_days",
]
