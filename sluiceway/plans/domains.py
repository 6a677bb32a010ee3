"""One run of a whole domain: sources to bronze, silver and gold."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from sluiceway.config import FileFeed, ResponseFeed
from sluiceway.functions.text import new_run_id
from sluiceway.plans import gold
from sluiceway.plans.tables import refresh_view
from sluiceway.sources.fetch import RetryPolicy, Transport, fetch_responses, land_run
from sluiceway.streaming import files, responses
from sluiceway.streaming.count_view import CountView
from sluiceway.streaming.keyed_table import KeyedTable


def run_responses(
    spark: SparkSession,
    feed: ResponseFeed,
    specs: DataFrame,
    transport: Transport,
    concurrency: int = 8,
    policy: RetryPolicy = RetryPolicy(),
    sleep: Callable[[float], None] = time.sleep,
    as_of: Column | str | None = None,
) -> dict:
    """Fetch, land, and bring bronze, the configured silver and both gold tables up to date."""
    run_id = new_run_id()
    fetched = fetch_responses(specs, transport, run_id, concurrency, policy=policy, sleep=sleep)
    landed = land_run(fetched, run_id, f"{feed.base}/staging/{run_id}", feed.landing)
    silver = responses.update(spark, feed)
    bronze = responses.read_bronze(spark, feed)
    health = gold.endpoint_health(bronze, as_of, corrected=True)
    refresh_view(health, f"{feed.base}/gold_api_endpoint_health", ["endpoint"])
    records_per_day(spark, feed, silver).refresh()
    return landed


def records_per_day(spark: SparkSession, feed: ResponseFeed, silver: KeyedTable | None = None) -> CountView:
    """Current rows by day and endpoint, kept up to date from the changes of silver."""
    table = silver or responses.silver_table(spark, feed)
    return CountView(spark, f"{feed.base}/gold_api_records_per_day", table, ["ingest_date", "endpoint"])


def run_files(spark: SparkSession, feed: FileFeed, as_of: Column | str | None = None) -> files.FileTables:
    """Ingest new files and bring silver and both gold tables up to date."""
    tables = files.update(spark, feed)
    health = gold.files_health(tables.bronze(), as_of, corrected=True)
    refresh_view(health, f"{feed.base}/gold_files_ingestion_health", ["ingest_date"])
    daily = f"{feed.base}/gold_files_rows_per_day"
    if not feed.dedup_keys:
        refresh_view(gold.rows_per_day(tables.silver()), daily, ["ingest_date"])
    elif tables.keyed().version() is not None:
        CountView(spark, daily, tables.keyed(), ["ingest_date"]).refresh()
    return tables
