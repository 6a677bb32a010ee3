"""Counts per group of a keyed table, kept up to date from its changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.plans.gold import refresh_counts
from sluiceway.storage import Folder
from sluiceway.streaming.keyed_table import KeyedTable


class CountView:
    """A stored count that knows which version of its table it reflects.

    A refresh reads the rows that changed since. It counts the whole table only the first time, or
    when the version it stands on has expired.
    """

    def __init__(self, spark: SparkSession, path: str, table: KeyedTable, by: Sequence[str]):
        self.spark, self.path, self.table, self.by = spark, path.rstrip("/"), table, list(by)
        self._folder = Folder(spark, self.path)

    def version(self) -> int | None:
        done = self._folder.matching("version=*/_SUCCESS")
        return max((int(n.split("/")[0].split("=")[1]) for n in done), default=None)

    def read(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/version={self.version()}")

    def full(self) -> DataFrame:
        return self.table.read().groupBy(*self.by).agg(F.count(F.lit(1)).alias("record_count"))

    def refresh(self) -> DataFrame:
        known, newest = self.version(), self.table.version()
        if known != newest:
            if known is not None and self.table.has(known):
                counts = refresh_counts(self.read(), self.table.changes(known, newest), self.by)
            else:
                counts = self.full()
            counts.write.mode("overwrite").parquet(f"{self.path}/version={newest}")
            for stale in self._folder.names():
                if stale.startswith("version=") and int(stale.split("=")[1]) < (known or 0):
                    self._folder.remove(stale)
        return self.read()
