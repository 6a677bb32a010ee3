"""Monitoring aggregates, in full and refreshed from changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: days the health aggregates look back, today not counted.
HEALTH_DAYS = 7


def recent(df: DataFrame, as_of: Column | str | None = None, days: int = HEALTH_DAYS) -> DataFrame:
    """Rows ingested in the last days; the date reaches the scan as a filter."""
    if isinstance(as_of, str):
        as_of = F.lit(as_of).cast("date")
    today = F.current_date() if as_of is None else as_of
    return df.filter(F.col("ingest_date") >= F.date_sub(today, days))


def endpoint_health(bronze: DataFrame, as_of: Column | str | None = None, corrected: bool = False) -> DataFrame:
    """Freshness, volume and errors per endpoint.

    ``network_error_count`` counts every row with an error message and ``avg_body_bytes`` counts
    characters. ``corrected`` adds columns that count only server or transport errors, and octets.
    """
    status = F.col("status_code")
    measures = [
        F.max("fetched_at").alias("last_fetched_at"),
        F.count(F.lit(1)).alias("total_calls"),
        F.count_if(status.between(200, 299)).alias("success_count"),
        F.count_if(status.between(400, 599)).alias("error_count"),
        F.count_if(F.col("error_message").isNotNull()).alias("network_error_count"),
        F.avg(F.length("response_body")).alias("avg_body_bytes"),
    ]
    if corrected:
        failed = F.col("error_message").isNotNull() & (status.isNull() | (status >= 500))
        measures += [
            F.count_if(failed).alias("server_or_transport_error_count"),
            F.avg(F.octet_length("response_body")).alias("avg_body_octets"),
        ]
    counted = recent(bronze, as_of).groupBy("endpoint").agg(*measures)
    return counted.select("*", F.try_divide("success_count", "total_calls").alias("success_rate"))


def records_per_day(silver: DataFrame) -> DataFrame:
    """Current rows by the day they were last fetched and by endpoint, for either silver shape."""
    return silver.groupBy("ingest_date", "endpoint").agg(F.count(F.lit(1)).alias("record_count"))


def files_health(bronze: DataFrame, as_of: Column | str | None = None, corrected: bool = False) -> DataFrame:
    """Files, rows, bytes and freshness per ingest day.

    Rows are first reduced per file, which replaces the distinct count by a sum and makes the
    second shuffle one row per file. ``total_bytes`` counts a file once per row;
    ``distinct_file_bytes`` once.
    """
    per_file = recent(bronze, as_of).groupBy("ingest_date", "source_file").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("source_file_size").alias("row_bytes"),
        F.max("source_file_size").alias("file_bytes"),
        F.max("source_file_modified_at").alias("modified_at"),
        F.max("_ingested_at").alias("ingested_at"),
    )
    measures = [
        F.count("source_file").alias("files_ingested"),
        F.sum("rows").alias("rows_ingested"),
        F.sum("row_bytes").alias("total_bytes"),
        F.max("modified_at").alias("latest_source_file_at"),
        F.max("ingested_at").alias("last_ingest_run_at"),
    ]
    if corrected:
        measures.append(F.sum("file_bytes").alias("distinct_file_bytes"))
    return per_file.groupBy("ingest_date").agg(*measures)


def rows_per_day(silver: DataFrame) -> DataFrame:
    return silver.groupBy("ingest_date").agg(F.count(F.lit(1)).alias("record_count"))


def refresh_counts(
    counts: DataFrame, changes: DataFrame, by: Sequence[str], count: str = "record_count"
) -> DataFrame:
    """Counts after row-level changes, without reading the table again.

    A row adds one to the group of its new image and takes one from the group of its old image, so
    rows that move between groups come out right. Groups that fall to zero disappear.
    """

    def side(image: str, amount: int) -> DataFrame:
        there = changes.filter(F.col(image).isNotNull())
        grouping = [F.coalesce(*_places(changes, image, c)).alias(c) for c in by]
        return there.select(*grouping, F.lit(amount).cast("bigint").alias(count))

    moved = side("_after", 1).unionByName(side("_before", -1))
    return (
        counts.select(*by, count)
        .unionByName(moved)
        .groupBy(*by)
        .agg(F.sum(count).alias(count))
        .filter(F.col(count) > 0)
    )


def _places(changes: DataFrame, image: str, name: str) -> list[Column]:
    """A grouping column is a key of the changes or a field of the image."""
    return [F.col(name)] if name in changes.columns else [F.col(f"{image}.`{name}`")]


#: Registers of a distinct-count sketch, as a power of two: a standard error of about 0.4 %, and 64 KB at most.
SKETCH_BITS = 16


def distinct_sketches(rows: DataFrame, by: Sequence[str], column: str) -> DataFrame:
    """Per group a sketch of the values of a column, and the rows it stands for. NULL is no value.

    Sketches of any groups add up, so a new day or file adds its own row and reads no older one.
    """
    return rows.groupBy(*by).agg(F.hll_sketch_agg(column, F.lit(SKETCH_BITS)).alias("sketch"), F.count(F.lit(1)).alias("rows"))


def distinct_counts(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Distinct values over any union of sketched groups, without their rows."""
    return sketches.groupBy(*by).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"), F.sum("rows").alias("rows")
    )
