"""Tables that Spark keeps in buckets of their keys, so that a merge does not shuffle what is stored.

A stored table is hashed and sorted by its keys once, when it is first written. A merge then shuffles
only the change set, to the same buckets, and writes the next state into the same buckets again. This
pays where change sets are large or hit every part of a table; where they hit few slices, rewriting only
those is less work. Bucketed tables live in the session's catalog.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.merge import upsert


def save_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """Write ``df`` as the new table ``table`` and return it as read back.

    One file per bucket, sorted by the keys. ``buckets`` should make files of some hundred megabytes, and be
    no fewer than the session's shuffle partitions: with fewer, Spark would rather shuffle the table. Rows
    with a NULL key share a bucket. With ``path`` the files lie there and outlive the table's name.
    """
    return _write(df.repartition(buckets, *keys), table, keys, buckets, path)


def upsert_bucketed(
    spark: SparkSession,
    stored: str,
    source: DataFrame,
    keys: Sequence[str],
    load_id: str,
    load_ts: datetime,
    into: str,
    path: str | None = None,
) -> DataFrame:
    """Merge ``source`` into the bucketed table ``stored``; the next state is the new table ``into``, in the same buckets.

    The rules are those of ``upsert``. The stored table is left as it is, so that a run that dies can be
    repeated; whoever calls drops the older of the two.
    """
    buckets = bucket_count(spark, stored, keys)
    state = upsert(spark.table(stored), source, keys, load_id, load_ts, plan="outer")
    # Unkeyed rows come behind the join; all other rows are where they belong already.
    return _write(state, into, keys, buckets, path)


def bucket_count(spark: SparkSession, table: str, keys: Sequence[str]) -> int:
    """How many buckets a table has; an error if it is not bucketed by ``keys``."""
    found = {r["col_name"]: r["data_type"] for r in spark.sql(f"describe table extended {table}").collect()}
    by = [c.strip().strip("`") for c in found.get("Bucket Columns", "").strip("[]").split(",") if c.strip()]
    if by != list(keys):
        raise ValueError(f"{table} is bucketed by {by}, not by {list(keys)}")
    return int(found["Num Buckets"])


def _write(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str | None) -> DataFrame:
    writer = df.write.bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)
