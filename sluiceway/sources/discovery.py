"""New files of a folder, found by Spark: listed in tasks and held against a table of digests."""

from __future__ import annotations

import fnmatch
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.session import scratch_path
from sluiceway.storage import Folder

_ENTRY = "path string, is_folder boolean, modificationTime timestamp, length bigint"
_SCHEMA = pa.schema([("path", pa.string()), ("is_folder", pa.bool_()), ("modificationTime", pa.timestamp("us", tz="UTC")), ("length", pa.int64())])
#: Entries that a task hands on at once.
HELD = 10_000


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One level below each folder. Names with a leading mark are notes of writers, or files being written."""
    for batch in batches:
        for folder in batch.column("path").to_pylist():
            system, place = pa.fs.FileSystem.from_uri(folder)
            start = folder[: len(folder) - len(place)] if folder.endswith(place) else ""
            held: list[dict] = []
            for entry in system.get_file_info(pa.fs.FileSelector(place, allow_not_found=True)):
                if entry.base_name.startswith(("_", ".")):
                    continue
                when = datetime.fromtimestamp(0 if entry.mtime_ns is None else entry.mtime_ns / 1e9, timezone.utc)
                held.append({"path": start + entry.path, "is_folder": entry.type == pa.fs.FileType.Directory, "modificationTime": when, "length": entry.size or 0})
                if len(held) >= HELD:
                    yield pa.RecordBatch.from_pylist(held, _SCHEMA)
                    held = []
            if held:
                yield pa.RecordBatch.from_pylist(held, _SCHEMA)


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """``(path, modificationTime, length)`` of all files below a folder; ``path`` is on any file system pyarrow knows.

    One job per level of folders: its tasks list the folders of the level above. What is found stays
    in stored tables; the driver learns how many folders there are, and no names but the first.
    """
    level = spark.createDataFrame([(path.rstrip("/"),)], "path string")
    found, base = None, scratch_path(spark, "listing")
    for depth in range(1_000):
        level.select("path").repartition("path").mapInArrow(_entries, _ENTRY).write.parquet(f"{base}/level={depth}")
        entries = spark.read.schema(_ENTRY).parquet(f"{base}/level={depth}")
        files = entries.filter("NOT is_folder").drop("is_folder")
        found = files if found is None else found.unionAll(files)
        level = entries.filter("is_folder")
        if level.isEmpty():
            break
    if pattern:
        found = found.filter(F.element_at(F.split("path", "/"), -1).rlike(fnmatch.translate(pattern)))
    return found


class SeenFiles:
    """Which files a feed has taken, batch by batch, as a table of digests and paths.

    A batch is planned before it is worked on. A job that ends in between finds the plan and goes on
    with the same files.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._folder = Folder(spark, self.path)

    def planned(self) -> int:
        """The number of the latest plan, -1 if there is none."""
        found = self._folder.matching("batch=*/_SUCCESS")
        return max((int(n.split("/")[0].partition("=")[2]) for n in found), default=-1)

    def files(self, batch: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/batch={batch}").select("path", "modificationTime", "length")

    def unseen(self, listing: DataFrame) -> DataFrame:
        """Listed files that no plan holds. Digests bring equal paths together, the paths themselves decide."""
        digest = F.xxhash64("path")
        if self.planned() < 0:
            return listing
        seen = self.spark.read.parquet(self.path).select("digest", "path")
        return listing.withColumn("digest", digest).join(seen, ["digest", "path"], "left_anti").drop("digest")

    def plan(self, listing: DataFrame, max_files: int) -> int | None:
        """The oldest ``max_files`` files not seen as the next batch; its number, or None if there are none."""
        number = self.planned() + 1
        chosen = self.unseen(listing).orderBy("modificationTime", "path").limit(max_files)
        rows = chosen.withColumn("digest", F.xxhash64("path")).repartitionByRange("digest").sortWithinPartitions("digest")
        rows.write.mode("overwrite").parquet(f"{self.path}/batch={number}")
        if not self.files(number).isEmpty():
            return number
        self._folder.remove(f"batch={number}")
        return None
