"""Small frames for the operator tests."""

from __future__ import annotations

from collections import Counter
from datetime import datetime

D = datetime.fromisoformat
LOAD_AT = D("2024-02-01 06:00:00")
EARLIER = D("2024-01-01 06:00:00")

AUDIT = "dw_create_dt timestamp_ntz, dw_mdfctn_dt timestamp_ntz, dw_load_id string, dw_update_id string"
VERSIONS = AUDIT + ", dw_eff_start_dt timestamp_ntz, dw_eff_end_dt timestamp_ntz"
OLD = (EARLIER, EARLIER, "L0", None)
NEW = (LOAD_AT, LOAD_AT, "L1", None)
UPDATED = (EARLIER, LOAD_AT, "L0", "L1")


def rows(df) -> Counter:
    return Counter(tuple(r) for r in df.collect())
