"""Text rows to typed rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType


def conform(df: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rejected text rows).

    A row is rejected when a value is there but does not read as the declared type. The two
    parts together are all of ``df``; an empty field is a NULL, not an error.
    """
    raw = df.select(*[f.name for f in schema.fields])
    broken = reduce(
        lambda a, b: a | b,
        [
            F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
            for f in schema.fields
            if not isinstance(f.dataType, StringType)
        ],
        F.lit(False),
    )
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    return raw.where(~broken).select(*typed), raw.where(broken)
