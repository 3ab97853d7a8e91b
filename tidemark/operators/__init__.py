"""DataFrame-to-DataFrame operators. Nothing here runs a job unless its docstring says so."""

from tidemark.operators.counts import load_counts
from tidemark.operators.distincts import daily_from_state, daily_state, distinct_counts, distinct_state, merge_daily, merge_states
from tidemark.operators.merge import duplicate_matches, insert_absent, matched_keys, upsert, within_key_range
from tidemark.operators.refresh import drop_slices, refresh_slices
from tidemark.operators.sales import daily_sales, fact_sales_delta, impacted_dates
from tidemark.operators.scd2 import Scd2Parts, apply_scd2, open_versions, scd2_parts
from tidemark.operators.updates import append_rows, keyed_update, update_from
from tidemark.operators.windows import change_window, day_window, load_bounds

__all__ = [
    "Scd2Parts",
    "append_rows",
    "apply_scd2",
    "change_window",
    "daily_from_state",
    "daily_sales",
    "daily_state",
    "day_window",
    "distinct_counts",
    "distinct_state",
    "drop_slices",
    "duplicate_matches",
    "fact_sales_delta",
    "impacted_dates",
    "insert_absent",
    "keyed_update",
    "load_bounds",
    "load_counts",
    "matched_keys",
    "merge_daily",
    "merge_states",
    "open_versions",
    "refresh_slices",
    "scd2_parts",
    "update_from",
    "upsert",
    "within_key_range",
]
