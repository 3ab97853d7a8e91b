"""Reading and writing: text extracts, parquet snapshots, stored tables."""

from tidemark.sources.bucketed import save_bucketed, upsert_bucketed
from tidemark.sources.eventlog import EventLog
from tidemark.sources.files import read_csv, read_snapshot, write_snapshot
from tidemark.sources.partitioned import PartitionedTable
from tidemark.sources.shared import own_path, shared_folder, stage
from tidemark.sources.tables import Tables

__all__ = [
    "EventLog",
    "PartitionedTable",
    "Tables",
    "own_path",
    "read_csv",
    "read_snapshot",
    "save_bucketed",
    "shared_folder",
    "stage",
    "upsert_bucketed",
    "write_snapshot",
]
