"""Size checks ahead of a choice between plans, by Spark's own estimates."""

from __future__ import annotations

from pyspark.sql import DataFrame


def planned_bytes(df: DataFrame) -> int:
    """Spark's estimate of the size of ``df``: for a scan, that of its files and columns."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def below_broadcast_threshold(df: DataFrame) -> bool:
    """Whether that estimate lets Spark broadcast ``df`` under the session's settings."""
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    return planned_bytes(df) <= conf.autoBroadcastJoinThreshold()
