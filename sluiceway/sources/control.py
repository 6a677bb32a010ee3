"""Endpoint control tables and request specs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.text import BLANKS, is_truthy, stripped

# The control-table columns in order; the last three may be absent.
CONTROL_COLUMNS = (
    "domain", "endpoint_name", "path", "method", "params", "schedule", "enabled",
    "body", "auth_mode", "silver_shape",
)
OPTIONAL_COLUMNS = ("body", "auth_mode", "silver_shape")

SPEC_ARRAY = (
    "array<struct<path:string,method:string,body:variant,headers:map<string,string>,name:string>>"
)


def with_control_columns(df: DataFrame) -> DataFrame:
    """Optional columns filled with NULL; a missing required one is an error."""
    missing = [c for c in CONTROL_COLUMNS if c not in df.columns]
    required = [c for c in missing if c not in OPTIONAL_COLUMNS]
    if required:
        raise ValueError(f"control table lacks {', '.join(required)}")
    return df.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else df


def read_control_csv(spark: SparkSession, path: str) -> DataFrame:
    """A control table from CSV; every cell is text. ``row_no`` keeps the order of the file."""
    cells = (
        spark.read.option("header", True).option("inferSchema", False)
        .option("multiLine", True).option("escape", '"').csv(path)
    )
    return with_control_columns(cells).withColumn("row_no", F.monotonically_increasing_id())


def read_control_table(spark: SparkSession, name: str, order_by: str | None = None) -> DataFrame:
    """A control table from the catalog, whatever the order of its columns.

    A table has no row order: the order of endpoints is ``order_by``, else domain, name and path.
    """
    rows = with_control_columns(spark.read.table(name))
    key = [F.col(order_by)] if order_by else [F.col(c) for c in ("domain", "endpoint_name", "path")]
    return rows.withColumn("row_no", F.struct(*key))


def control_slice(control: DataFrame, domain: str) -> DataFrame:
    """The enabled rows of one domain, read when the fetch runs."""
    return control.filter(is_truthy(F.col("enabled")) & (stripped(F.col("domain")) == domain.strip(BLANKS)))


def specs_from_list(df: DataFrame, column: str) -> DataFrame:
    """GET specs out of comma-separated paths, one row each."""
    path = F.explode(F.split(F.col(column), ","))
    return (
        df.select(*[c for c in df.columns if c != column], path.alias("_path"))
        .withColumn("path", stripped(F.col("_path")))
        .filter(F.col("path") != "")
        .drop("_path")
        .withColumns(
            {
                "method": F.lit("GET"),
                "body": F.lit(None).cast("string"),
                "headers": F.lit(None).cast("map<string,string>"),
                "name": F.lit(None).cast("string"),
            }
        )
    )


def specs_from_json(df: DataFrame, column: str) -> DataFrame:
    """Specs out of JSON arrays, one row each; ``body`` stays JSON text. A malformed array is an error."""
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.explode(F.from_json(F.col(column), SPEC_ARRAY, {"mode": "FAILFAST"})).alias("spec")).select(
        *others, "spec.path", "spec.method", F.to_json("spec.body").alias("body"),
        "spec.headers", "spec.name",
    )


def request_specs(spark: SparkSession, endpoints: str = "", endpoints_json: str = "") -> DataFrame:
    """Specs from job parameters: the JSON array wins over the list when it is not blank."""
    source, text = (
        (specs_from_json, endpoints_json) if endpoints_json.strip(BLANKS) else (specs_from_list, endpoints)
    )
    given = spark.createDataFrame([(text,)], T.StructType([T.StructField("text", T.StringType())]))
    return source(given, "text")


def specs_from_rows(spark: SparkSession, rows: list[Mapping]) -> DataFrame:
    """Specs from Python mappings."""
    import json

    return request_specs(spark, endpoints_json=json.dumps(rows))
