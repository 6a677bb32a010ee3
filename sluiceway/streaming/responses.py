"""Landing to bronze to silver, as triggered streams."""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from sluiceway.config import DOCUMENT, ResponseFeed
from sluiceway.operators import quality
from sluiceway.operators.parse import enrich_responses, explode_records, select_documents
from sluiceway.sources.landing import landing_schema, stream_landing
from sluiceway.streaming.events import append_events
from sluiceway.streaming.keyed_table import KeyedTable

SEQUENCE = ["fetched_at"]
#: How long the counts of a stream that has ended may be under way.
EVENTS_SECONDS = 600


def bronze_path(feed: ResponseFeed) -> str:
    return f"{feed.base}/bronze_api_responses"


def silver_table(spark: SparkSession, feed: ResponseFeed) -> KeyedTable:
    name = "silver_api_documents" if feed.silver_shape == DOCUMENT else "silver_api_records"
    cluster = ["endpoint", "ingest_date"] if feed.silver_shape == DOCUMENT else ["endpoint", "record_id"]
    return KeyedTable(
        spark, f"{feed.base}/{name}", feed.keys, SEQUENCE, buckets=feed.buckets, sort_by=cluster
    )


def read_bronze(spark: SparkSession, feed: ResponseFeed) -> DataFrame:
    """All of bronze, with the columns that landing has got since the oldest files were written."""
    found = spark.read.parquet(bronze_path(feed)).schema
    names = {f.name.lower() for f in found}
    added = [f for f in landing_schema(spark, feed.landing) if f.name.lower() not in names]
    return spark.read.schema(T.StructType(found.fields + added)).parquet(bronze_path(feed))


def start_bronze(
    spark: SparkSession,
    feed: ResponseFeed,
    schema: T.StructType | None = None,
    ingested_at: Column | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Append what is new in landing to bronze, then stop.

    Partitioned by day, so that the rolling health window reads only its days. A stream cannot
    sort its rows, so clustering by endpoint is left to silver and gold.
    """
    landing = stream_landing(spark, feed.landing, schema, max_files)
    bronze = enrich_responses(landing, ingested_at)
    rules = (*quality.BRONZE_RESPONSES, quality.UNPARSEABLE)
    listener = BatchCounts(spark, "bronze_api_responses")
    spark.streams.addListener(listener)
    query = (
        bronze.observe("bronze_api_responses", *quality.measures(rules))
        .writeStream.format("parquet")
        .partitionBy("ingest_date")
        .option("checkpointLocation", f"{feed.base}/checkpoints/bronze_api_responses")
        .trigger(availableNow=True)
        .start(bronze_path(feed))
    )
    query.batch_counts = listener
    return query


class BatchCounts(StreamingQueryListener):
    """The observed counts of every batch. A query itself only remembers its latest ones."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.ended = spark, name, threading.Event()
        self.counts: dict[str, dict[int, dict]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found = event.progress.observedMetrics.get(self.name)
        if found is not None:
            self.counts.setdefault(str(event.progress.runId), {})[event.progress.batchId] = found.asDict()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) in self.counts:
            self.ended.set()


def bronze_quality(query: StreamingQuery) -> dict[int, list[tuple]]:
    """Quality events of a bronze stream by batch, once it has ended; no batch is left out."""
    query.awaitTermination()
    rules = (*quality.BRONZE_RESPONSES, quality.UNPARSEABLE)
    listener = query.batch_counts
    observed = query.lastProgress and query.lastProgress.observedMetrics
    complete = not observed or listener.ended.wait(EVENTS_SECONDS)  # events come in order, the end last
    listener.spark.streams.removeListener(listener)
    if not complete:
        raise TimeoutError(f"the counts of run {query.runId} did not come within {EVENTS_SECONDS} seconds")
    found = listener.counts.get(str(query.runId), {})
    return {b: quality.events(c, "bronze_api_responses", rules, b) for b, c in sorted(found.items())}


def start_silver(
    spark: SparkSession, feed: ResponseFeed, max_files: int | None = None
) -> StreamingQuery:
    """Upsert what is new in bronze into the current state, then stop."""
    table = silver_table(spark, feed)
    document = feed.silver_shape == DOCUMENT
    parse = select_documents if document else explode_records
    rules = quality.SILVER_DOCUMENTS if document else quality.SILVER_RECORDS
    name = table.path.rpartition("/")[2]

    def apply(batch: DataFrame, batch_id: int) -> None:
        if table.applied(name) >= batch_id:
            return
        rows, seen = quality.watch(parse(batch), rules)

        def settle() -> None:
            found = quality.check(seen, name, rules, batch_id)
            append_events(spark, f"{feed.base}/quality_events", found, name, batch_id)

        table.upsert(quality.drop_violations(rows, rules), name, batch_id, before_commit=settle)

    schema = read_bronze(spark, feed).schema
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        reader.parquet(bronze_path(feed))
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", f"{feed.base}/checkpoints/{name}")
        .trigger(availableNow=True)
        .start()
    )


def update(
    spark: SparkSession,
    feed: ResponseFeed,
    schema: T.StructType | None = None,
    ingested_at: Column | None = None,
    max_files: int | None = None,
) -> KeyedTable:
    """One triggered run: process everything new, then stop."""
    bronze = start_bronze(spark, feed, schema, ingested_at, max_files)
    bronze.awaitTermination()
    for batch_id, found in bronze_quality(bronze).items():
        append_events(spark, f"{feed.base}/quality_events", found, "bronze_api_responses", batch_id)
    start_silver(spark, feed, max_files).awaitTermination()
    return silver_table(spark, feed)
