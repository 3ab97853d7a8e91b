"""Change windows: which rows a load picks up."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame

from tidemark.functions.literals import closed_range


def change_window(
    df: DataFrame,
    start: datetime | str,
    end: datetime | str,
    mode: str = "either",
    created: str = "create_dt",
    modified: str = "mdfctn_dt",
) -> DataFrame:
    """Rows created or modified in the closed window.

    ``either`` keeps a row when one of the two times is in the window (landing, gold); ``both``
    wants the two of them (silver), so it leaves out later changes of rows created before the window.
    """
    return df.where(in_window(df, start, end, mode, created, modified))


def in_window(
    df: DataFrame,
    start: datetime | str,
    end: datetime | str,
    mode: str = "either",
    created: str = "create_dt",
    modified: str = "mdfctn_dt",
) -> Column:
    """The predicate of ``change_window``."""
    c = closed_range(created, df.schema[created].dataType, start, end)
    m = closed_range(modified, df.schema[modified].dataType, start, end)
    if mode == "either":
        return c | m
    if mode == "both":
        return c & m
    raise ValueError(f"mode must be 'either' or 'both', not {mode!r}")


def day_window(year: int, month: int, day: int) -> tuple[datetime, datetime]:
    """From one second before the day to its last second."""
    midnight = datetime(year, month, day)
    return midnight - timedelta(seconds=1), midnight + timedelta(days=1, seconds=-1)


def load_bounds(
    control: tuple[datetime, datetime], year: str = "0", month: str = "0", day: str = "0"
) -> tuple[datetime, datetime]:
    """The control table's bounds unless year, month and day all name a date.

    An impossible date raises ``ValueError``.
    """
    if "0" in (year, month, day):
        return control
    return day_window(int(year), int(month), int(day))
