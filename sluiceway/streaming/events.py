"""The quality_events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.operators.quality import EVENT_SCHEMA


def append_events(spark: SparkSession, path: str, events: list[tuple], writer: str, batch_id: int) -> None:
    """Append the counts of a batch, a few rows; a repeated batch replaces its own."""
    if events:
        target = f"{path}/writer={writer}/batch={batch_id}"
        event_rows(spark, events).write.mode("overwrite").parquet(target)


def event_rows(spark: SparkSession, events: list[tuple]) -> DataFrame:
    """The events as rows of one partition, built from literals without a Python task."""
    kinds = [column.rsplit(" ", 1) for column in EVENT_SCHEMA.replace("`", "").split(", ")]
    lines = [
        F.struct(*[F.lit(value).cast(kind).alias(name) for value, (name, kind) in zip(event, kinds)])
        for event in events
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*lines)))


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVENT_SCHEMA).option("recursiveFileLookup", True).parquet(path)
