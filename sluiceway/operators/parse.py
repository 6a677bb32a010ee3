"""Bronze responses into records or documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEADING = ["endpoint", "url", "status_code", "fetched_at", "_ingested_at", "ingest_date", "run_id"]


def enrich_responses(landing: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Ingest stamps and the parsed body.

    A body that is not JSON gives NULL instead of failing the batch; the raw text stays.
    """
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    return landing.select(
        "*",
        stamp.alias("_ingested_at"),
        F.to_date(stamp).alias("ingest_date"),
        F.try_parse_json("response_body").alias("response_variant"),
    )


def body_records(body: Column) -> Column:
    """The body as an array of string maps: an array of objects, or one object."""
    many = F.from_json(body, "array<map<string,string>>")
    single = F.from_json(body, "map<string,string>")
    return F.coalesce(many, F.array(single))


def explode_records(bronze: DataFrame) -> DataFrame:
    """One row per record of a response; responses without a usable record give none.

    ``explode`` rather than its outer form: the rows it would add are exactly those the NULL
    filter takes away again.
    """
    keep = [c for c in bronze.columns if c in LEADING]
    return (
        bronze.select(*keep, F.explode(body_records(F.col("response_body"))).alias("record"))
        .filter(F.col("record").isNotNull())
        .select(*keep, F.to_json("record").alias("record_json"), F.col("record")["id"].alias("record_id"))
    )


def select_documents(bronze: DataFrame) -> DataFrame:
    """One row per response whose body parsed."""
    keep = [c for c in bronze.columns if c in LEADING]
    return bronze.select(*keep, "response_variant", "response_body").filter(
        F.col("response_variant").isNotNull()
    )


def variant_field(column: str, path: str, as_type: str) -> Column:
    """A typed field of a VARIANT column; NULL where it is missing or does not fit."""
    return F.try_variant_get(F.col(column), path if path.startswith("$") else f"$.{path}", as_type)


def explode_variant(df: DataFrame, column: str, path: str = "$") -> DataFrame:
    """One row per element (or field) of a VARIANT array (or object): ``pos``, ``key``, ``value``."""
    inner = F.try_variant_get(F.col(column), path, "variant")
    view = df.withColumn("_inner", inner)
    return view.lateralJoin(
        view.sparkSession.tvf.variant_explode(F.col("_inner").outer())
    ).drop("_inner")
