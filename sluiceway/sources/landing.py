"""The landing table: one row per request, append-only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.sources.files import SchemaRegistry

LANDING_SCHEMA = T.StructType(
    [
        T.StructField("endpoint", T.StringType(), False),
        T.StructField("url", T.StringType(), False),
        T.StructField("status_code", T.IntegerType(), True),
        T.StructField("response_body", T.StringType(), True),
        T.StructField("error_message", T.StringType(), True),
        T.StructField("fetched_at", T.TimestampType(), False),
        T.StructField("run_id", T.StringType(), False),
        T.StructField("attempts", T.IntegerType(), True),
    ]
)


def landing_schema(spark: SparkSession, path: str) -> T.StructType:
    """The fixed columns, and after them those that writers have added so far."""
    fixed = {f.name.lower() for f in LANDING_SCHEMA}
    added = [f for f in SchemaRegistry(spark, f"{path}/_columns").current() if f.name.lower() not in fixed]
    return T.StructType(LANDING_SCHEMA.fields + added)


def append_landing(responses: DataFrame, path: str) -> None:
    """One folder per run, so that checking or reading a run touches nothing else.

    The columns are noted beside the runs, so that a stream learns of new ones without reading every footer.
    """
    SchemaRegistry(responses.sparkSession, f"{path}/_columns").evolve(responses.schema)
    responses.write.mode("append").partitionBy("run_id").parquet(path)


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """All landed rows; columns that later writers added are merged in."""
    rows = spark.read.option("mergeSchema", "true").parquet(path)
    return rows.withColumn("run_id", F.col("run_id").cast("string"))


def stream_landing(
    spark: SparkSession, path: str, schema: T.StructType | None = None, max_files: int | None = None
) -> DataFrame:
    """New landing files only; files are never rewritten, so every row is an append."""
    reader = spark.readStream.schema(schema or landing_schema(spark, path))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
