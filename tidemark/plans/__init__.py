"""Restartable loads driven by control tables."""

from tidemark.plans.control import (
    advance_window,
    due_files,
    load_range,
    pending,
    pending_landing,
    pick_files,
    register_files,
    run_outcome,
    unprocessed,
    unprocessed_names,
)
from tidemark.plans.loads import LoadError, Warehouse
from tidemark.plans.runlog import latest_run, run_log_current

__all__ = [
    "LoadError",
    "Warehouse",
    "advance_window",
    "due_files",
    "latest_run",
    "load_range",
    "pending",
    "pending_landing",
    "pick_files",
    "register_files",
    "run_log_current",
    "run_outcome",
    "unprocessed",
    "unprocessed_names",
]
