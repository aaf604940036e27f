"""Table folders: every write makes a new version folder, and a line added to the list of versions then names it."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from worklode.session import shared_dir


class TableStore:
    """Versioned Parquet tables below one root folder shared by all executors.

    A table is never overwritten in place, so a job may read the state it replaces, and a lost executor
    only repeats its own tasks.  The list of versions is only ever added to, as the last step of a write, and the
    one with the highest number counts: a write that stops before has changed nothing.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or shared_dir(spark)).rstrip("/")

    def replace(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        path = f"{self.root}/{name}/v-{uuid.uuid4().hex}"
        writer = df.write.mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        number = 0 if (last := self._last(name)) is None else last.number + 1
        entry = self.spark.createDataFrame([(number, path)], "number long, path string")
        entry.coalesce(1).write.mode("append").json(f"{self.root}/{name}/versions")
        return self.spark.read.parquet(path)

    def _last(self, name: str) -> Row | None:
        try:
            listed = self.spark.read.schema("number long, path string").json(f"{self.root}/{name}/versions")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return listed.orderBy(F.desc("number"), "path").first()

    def exists(self, name: str) -> bool:
        return self._last(name) is not None

    def read(self, name: str) -> DataFrame:
        last = self._last(name)
        if last is None:
            raise ValueError(f"table {name} has no version")
        return self.spark.read.parquet(last.path)

    def append(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> str:
        """Append with the schema of ``df`` to an append-only log folder."""
        path = f"{self.root}/{name}/log"
        writer = df.write.mode("append")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        return path


def refresh(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Full refresh of a table: write a new version, switch the pointer, read the new version."""
    return TableStore(df.sparkSession, f"{shared_dir(df.sparkSession)}/run-{uuid.uuid4().hex}").replace(name, df, partition_by)
