"""Timestamp literals typed like the column they meet, so the column itself is never cast.

A cast on the column side would keep the comparison out of the parquet scan.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, TimestampNTZType


def ts_literal(value: datetime | date | str, like: DataType | None = None) -> Column:
    return F.lit(str(value)).cast(like or TimestampNTZType())


def as_moment(value: datetime | str) -> datetime:
    return value if isinstance(value, datetime) else datetime.fromisoformat(value)


def closed_range(name: str, dtype: DataType, start: datetime | str, end: datetime | str) -> Column:
    """``start <= column <= end``. Text columns are parsed first; unreadable text is not in range."""
    col = F.col(name)
    if isinstance(dtype, StringType):
        dtype = TimestampNTZType()
        col = col.try_cast(dtype)
    return col.between(ts_literal(start, dtype), ts_literal(end, dtype))


def whole_days(name: str, dtype: DataType, start: datetime | str, end: datetime | str) -> Column:
    """``date(column) between date(start) and date(end)`` as a half-open range on the raw column."""
    first = as_moment(start).date()
    after = as_moment(end).date() + timedelta(days=1)
    col = F.col(name)
    return (col >= ts_literal(first, dtype)) & (col < ts_literal(after, dtype))
