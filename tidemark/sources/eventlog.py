"""A log to which runs append events, each run in a folder of its own.

An event costs one small file, however long the log is, and writers never meet: every append has a folder
of its own below that of its run. When a run ends its files are put into one. So the log has one file per
ended run and a few of the open ones.
"""

from __future__ import annotations

import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

RUN, BATCH = "dw_run", "dw_batch"


class EventLog:
    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self._stored = StructType([*schema.fields, StructField(RUN, StringType()), StructField(BATCH, StringType())])

    def append(self, run: str, events: DataFrame) -> None:
        """Add events of a run. Several drivers may do so at once, also for one run."""
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        events.select(*columns).coalesce(1).write.parquet(self._batch(run))

    def read(self, run: str | None = None) -> DataFrame:
        """All events, or those of one run, of which only its files are opened.

        While a run is compacted, or if the driver died doing so, its events may be seen twice.
        """
        if not self._exists(self.path):
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self._stored).option("basePath", self.path).parquet(self.path)
        rows = rows if run is None else rows.where(F.col(RUN) == self._name(run))
        return rows.select(*self.schema.names)

    def compact(self, run: str) -> None:
        """Put the events of a run into one file. What others append meanwhile stays as it is."""
        folder = self._folder(run)
        old = self._children(folder)
        if len(old) < 2:
            return
        rows = self.spark.read.schema(self.schema).parquet(*[f"{folder}/{name}" for name in old])
        # An event that an interrupted call has written twice counts once; no two are alike.
        rows.distinct().coalesce(1).write.parquet(self._batch(run))
        for name in old:
            path = self._path(f"{folder}/{name}")
            self._fs(path).delete(path, True)

    def _name(self, run: str) -> str:
        return "r" + quote(run, safe="")  # never empty

    def _folder(self, run: str) -> str:
        # Quoted twice: Spark unquotes the names of folders once.
        return f"{self.path}/{RUN}={quote(self._name(run), safe='')}"

    def _batch(self, run: str) -> str:
        return f"{self._folder(run)}/{BATCH}={uuid.uuid4().hex}"

    # Through the file system Spark itself uses for the path.

    def _children(self, folder: str) -> list[str]:
        if not self._exists(folder):
            return []
        path = self._path(folder)
        return [s.getPath().getName() for s in self._fs(path).listStatus(path)]

    def _exists(self, place: str) -> bool:
        path = self._path(place)
        return self._fs(path).exists(path)

    def _path(self, text: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(text)

    def _fs(self, path):
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
