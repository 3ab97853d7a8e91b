"""A table with a folder per day or month of one column, of which a write replaces only those it touches.

It rests on Spark's dynamic partition overwrite. That replaces folders for which there are rows and leaves
all others; a folder that has lost its last row would thus keep its old ones. So such a folder gets a row
that only says so, and reading leaves these rows out.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from tidemark.sources.shared import stage

FOLDER, EMPTIED = "dw_folder", "dw_emptied"
_FORMATS = {"day": "yyyy-MM-dd", "month": "yyyy-MM"}


class PartitionedTable:
    """``column`` is a date or time column of ``schema``; rows without a value have a folder of their own."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, column: str, unit: str = "day"):
        if unit not in _FORMATS:
            raise ValueError(f"unit must be 'day' or 'month', not {unit!r}")
        self.spark, self.path, self.schema, self.column, self.unit = spark, path.rstrip("/"), schema, column, unit
        self._stored = StructType([*schema.fields, StructField(EMPTIED, BooleanType()), StructField(FOLDER, StringType())])

    def create(self) -> None:
        """The table without rows. One that exists is left as it is."""
        self.spark.createDataFrame([], self._stored).write.mode("append").partitionBy(FOLDER).parquet(self.path)

    def read(self, folders: Collection[str] | None = None) -> DataFrame:
        """All rows, or those of some folders, whose files are all that is opened."""
        rows = self.spark.read.schema(self._stored).parquet(self.path).where(F.col(EMPTIED).isNull())
        rows = rows if folders is None else rows.where(F.col(FOLDER).isin(list(folders)))
        return rows.select(*self.schema.names)

    def replace(self, rows: DataFrame, values: DataFrame) -> None:
        """For each value of ``column`` in ``values``, the table holds what ``rows`` has for it, which may be nothing.

        Rows of other values are not taken. Only the folders of the values are read and written: a month
        keeps its other days. A repeated call leaves the same rows. All new files are written before the
        first old one goes; a driver that dies while folders are exchanged leaves some old and some new,
        and repeating the call mends that.
        """
        kind = self.schema[self.column].dataType
        named = values.select(F.col(self.column).cast(kind).alias(self.column)).distinct()
        named = stage(named.select(F.col(self.column).alias("__value"), self._folder().alias(FOLDER)), "values")
        # There are few folders, so their names may be collected; values may be many.
        folders = [r[0] for r in named.select(FOLDER).distinct().collect()]
        if not folders:
            return
        same = F.col(self.column).eqNullSafe(F.col("__value"))
        typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        new = typed.join(named, same, "left_semi")
        if self.unit != "day" or kind.typeName() != "date":
            new = new.unionByName(self.read(folders).join(named, same, "left_anti"))
        # Taken once, as the folders that are left empty must be known as well.
        new = stage(new.withColumns({EMPTIED: F.lit(None).cast("boolean"), FOLDER: self._folder()}), "folders")
        gone = named.select(FOLDER).distinct().join(new.select(FOLDER).distinct(), FOLDER, "left_anti")
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        whole = new.unionByName(gone.select(*nothing, F.lit(True).alias(EMPTIED), FOLDER))
        writer = whole.select(*self._stored.names).hint("rebalance", FOLDER).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(FOLDER).parquet(self.path)

    def _folder(self) -> Column:
        return F.coalesce(F.date_format(F.col(self.column), _FORMATS[self.unit]), F.lit("none"))
