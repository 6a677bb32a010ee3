"""Dropped files to bronze to silver, driven by one discovery stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.config import FileFeed
from sluiceway.operators import quality
from sluiceway.sources.discovery import SeenFiles, list_files
from sluiceway.sources.files import SchemaRegistry, discover, read_files
from sluiceway.storage import Folder
from sluiceway.streaming.events import append_events
from sluiceway.streaming.keyed_table import KeyedTable

_ADDED = T.StructType(
    [
        T.StructField("_rescued_data", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("source_file_size", T.LongType()),
        T.StructField("source_file_modified_at", T.TimestampType()),
        T.StructField("_ingested_at", T.TimestampType()),
        T.StructField("ingest_date", T.DateType()),
    ]
)


class BatchTable:
    """An append-only table in which each batch has its own folder.

    A batch that was written is never written again, so a repeated micro-batch adds nothing;
    readers take finished batches only.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._folder = Folder(spark, path)

    def finished(self, batch_id: int) -> bool:
        return self._folder.exists(f"batch={batch_id}/_SUCCESS")

    def append(self, rows: DataFrame, batch_id: int) -> None:
        target = f"{self.path}/batch={batch_id}"
        rows.write.mode("overwrite").partitionBy("ingest_date").parquet(target)

    def read(self, schema: T.StructType, batch_id: int | None = None) -> DataFrame:
        """The rows of every finished batch, or of one.

        One path however many batches there are. Batches come one after another, so that at most the
        latest one is unfinished.
        """
        wanted = "*" if batch_id is None else str(batch_id)
        done = [int(n.split("/")[0].partition("=")[2]) for n in self._folder.matching(f"batch={wanted}/_SUCCESS")]
        path = self.path if batch_id is None else f"{self.path}/batch={batch_id}"
        if not done:
            return self.spark.createDataFrame([], schema)
        numbered = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
        rows = self.spark.read.schema(numbered).option("basePath", self.path).parquet(path)
        return rows.filter(F.col("batch") <= max(done)).select(*schema.names)


class FileTables:
    """The bronze and silver tables of one feed."""

    def __init__(self, spark: SparkSession, feed: FileFeed):
        self.spark, self.feed = spark, feed
        self.registry = SchemaRegistry(spark, f"{feed.base}/schemas")
        self._bronze = BatchTable(spark, f"{feed.base}/bronze_cloud_files")
        self._passed = BatchTable(spark, f"{feed.base}/silver_cloud_files_rows")

    def schema(self) -> T.StructType:
        return T.StructType(self.registry.current().fields + _ADDED.fields)

    def bronze(self) -> DataFrame:
        return self._bronze.read(self.schema())

    def keyed(self) -> KeyedTable:
        return KeyedTable(
            self.spark, f"{self.feed.base}/silver_cloud_files", list(self.feed.dedup_keys),
            [self.feed.dedup_order_by], buckets=self.feed.buckets, sort_by=["ingest_date"],
        )

    def silver(self) -> DataFrame:
        """Current state per key, or every row where no keys are configured."""
        return self.keyed().read() if self.feed.dedup_keys else self._passed.read(self.schema())

    def apply(self, files: DataFrame, batch_id: int, ingested_at: Column | None = None) -> None:
        """One micro-batch of discovered files; repeating it changes nothing."""
        if not self._bronze.finished(batch_id):
            # The file list of a batch, bounded by max_files.
            paths = [r["path"] for r in files.orderBy("modificationTime", "path").collect()]
            if not paths:
                return
            rows = read_files(self.spark, paths, self.feed.file_format, self.registry, self.feed.options)
            stamp = F.current_timestamp() if ingested_at is None else ingested_at
            stamped = rows.withColumn("_ingested_at", stamp).withColumn(
                "ingest_date", F.to_date("_ingested_at")
            )
            self._bronze.append(stamped, batch_id)
        self._apply_silver(self._bronze.read(self.schema(), batch_id), batch_id)

    def _apply_silver(self, rows: DataFrame, batch_id: int) -> None:
        name, rules = "silver_cloud_files", quality.SILVER_FILES
        watched, seen = quality.watch(rows, rules)

        def settle() -> None:
            found = quality.check(seen, name, rules, batch_id)
            append_events(self.spark, f"{self.feed.base}/quality_events", found, name, batch_id)

        if self.feed.dedup_keys:
            self.keyed().upsert(watched, name, batch_id, before_commit=settle)
        elif not self._passed.finished(batch_id):
            # Readers see a batch as soon as it is written, so what must not pass is counted before.
            strict = [rule for rule in rules if rule.action == "fail"]
            if strict:
                quality.refuse(rows, name, strict, batch_id)
            self._passed.append(watched, batch_id)
            settle()


def update(spark: SparkSession, feed: FileFeed, ingested_at: Column | None = None) -> FileTables:
    """One triggered run: ingest every file that is new since the last run, then stop."""
    tables = FileTables(spark, feed)
    query = (
        discover(spark, feed.source, feed.max_files, feed.options.get("pathGlobFilter"))
        .writeStream.foreachBatch(lambda files, batch_id: tables.apply(files, batch_id, ingested_at))
        .option("checkpointLocation", f"{feed.base}/checkpoints/bronze_cloud_files")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return tables


def update_listed(spark: SparkSession, feed: FileFeed, ingested_at: Column | None = None) -> FileTables:
    """One run as ``update`` makes it, with the files found by ``SeenFiles`` instead of a file stream.

    For folders with more files than a driver should know: paths stay in tables, and the driver
    sees those of one batch at a time. A feed uses one of the two ways for good.
    """
    tables, seen = FileTables(spark, feed), SeenFiles(spark, f"{feed.base}/seen_files")
    last = seen.planned()
    if last >= 0:  # done already, or left behind by a job that ended
        tables.apply(seen.files(last), last, ingested_at)
    listing = list_files(spark, feed.source, feed.options.get("pathGlobFilter"))
    while (number := seen.plan(listing, feed.max_files)) is not None:
        tables.apply(seen.files(number), number, ingested_at)
    return tables
