"""Compile a control table into the requests of each domain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.text import is_truthy, json_string, json_value, none_if_empty, stripped

# Settings a domain has unless a row says otherwise.
DEFAULT_AUTH_MODE = "connection"
DEFAULT_SILVER_SHAPE = "records"


def usable_rows(control: DataFrame) -> DataFrame:
    """Rows with a domain and a path; the rest does not even count as disabled."""
    return (
        control.withColumn("domain", stripped(F.col("domain")))
        .withColumn("path", stripped(F.col("path")))
        .filter((F.col("domain") != "") & (F.col("path") != ""))
        .withColumn("is_enabled", is_truthy(F.col("enabled")))
    )


def compile_specs(control: DataFrame) -> DataFrame:
    """One row per enabled endpoint: domain, full path, method, body as JSON text, settings."""
    params = stripped(F.col("params"))
    method = F.upper(stripped(F.col("method")))
    rows = usable_rows(control).filter("is_enabled").withColumn("body", none_if_empty(stripped(F.col("body"))))

    def setting(name: str, default: str) -> Column:
        value = F.lower(stripped(F.col(name)))
        return F.when(~value.isin("", default), value)

    return rows.select(
        "row_no",
        "domain",
        "endpoint_name",
        F.when(params != "", F.concat_ws("?", "path", params)).otherwise(F.col("path")).alias("path"),
        F.when(method == "", "GET").otherwise(method).alias("method"),
        json_value("body").alias("body"),
        none_if_empty(stripped(F.col("schedule"))).alias("schedule"),
        setting("auth_mode", DEFAULT_AUTH_MODE).alias("auth_mode"),
        setting("silver_shape", DEFAULT_SILVER_SHAPE).alias("silver_shape"),
    )


def _plain(method: Column, body: Column) -> Column:
    return (method == "GET") & body.isNull()


def compile_domains(specs: DataFrame) -> DataFrame:
    """One row per domain: settings, conflicts and counts.

    The first value in row order wins. Everything here reduces before the shuffle, whatever the
    size of a domain; the endpoints themselves stay one row each in ``compile_specs``.
    """

    def first(name: str) -> Column:
        return F.expr(f"min_by({name}, row_no) FILTER (WHERE {name} IS NOT NULL)")

    def conflict(name: str) -> Column:
        return F.min(name) != F.max(name)

    plain = _plain(F.col("method"), F.col("body"))
    return specs.groupBy("domain").agg(
        F.count(F.lit(1)).alias("endpoints"),
        F.count_if(~plain).alias("non_get_endpoints"),
        F.coalesce(first("schedule"), F.lit("")).alias("schedule"),
        F.coalesce(first("auth_mode"), F.lit(DEFAULT_AUTH_MODE)).alias("auth_mode"),
        F.coalesce(first("silver_shape"), F.lit(DEFAULT_SILVER_SHAPE)).alias("silver_shape"),
        F.coalesce(conflict("schedule"), F.lit(False)).alias("schedule_conflict"),
        F.coalesce(conflict("auth_mode"), F.lit(False)).alias("auth_mode_conflict"),
        F.coalesce(conflict("silver_shape"), F.lit(False)).alias("silver_shape_conflict"),
    )


def endpoint_parameters(specs: DataFrame) -> DataFrame:
    """The fetch parameter of each domain, in row order.

    A list of paths where every request is a plain GET and no path holds a comma, else a JSON
    array. The result is one job parameter, so a domain has as many endpoints here as fit one;
    a fetch over more reads ``compile_specs`` directly.
    """
    entry = F.concat(
        F.lit('{"path":'), json_string(F.col("path")),
        F.lit(',"method":'), json_string(F.col("method")),
        F.coalesce(F.concat(F.lit(',"body":'), F.col("body")), F.lit("")),
        F.lit("}"),
    )
    plain = _plain(F.col("method"), F.col("body")) & ~F.contains("path", F.lit(","))
    grouped = specs.select("domain", "row_no", "path", entry.alias("entry"), plain.alias("plain")).groupBy(
        "domain"
    ).agg(
        F.every("plain").alias("is_list"),
        F.array_sort(F.collect_list(F.struct("row_no", "path", "entry"))).alias("specs"),
    )
    return grouped.select(
        "domain",
        F.when(F.col("is_list"), F.array_join("specs.path", ",")).alias("api_endpoints"),
        F.when(
            ~F.col("is_list"), F.concat(F.lit("["), F.array_join("specs.entry", ","), F.lit("]"))
        ).alias("api_endpoints_json"),
    )


def compile_stats(control: DataFrame) -> DataFrame:
    """Counts over the whole table, in one pass."""
    usable = (stripped(F.col("domain")) != "") & (stripped(F.col("path")) != "")
    kept = usable & is_truthy(F.col("enabled"))
    method = F.upper(stripped(F.col("method")))
    special = ~method.isin("", "GET") | (stripped(F.col("body")) != "")
    return control.select(
        stripped(F.col("domain")).alias("domain"),
        usable.alias("usable"), kept.alias("kept"), (kept & special).alias("special"),
    ).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("kept").alias("enabled_endpoints"),
        F.count_distinct(F.when(F.col("kept"), F.col("domain"))).alias("domains"),
        F.count_if(F.col("usable") & ~F.col("kept")).alias("skipped_disabled"),
        F.count_if("special").alias("non_get_endpoints"),
    )


def duplicate_endpoints(specs: DataFrame) -> DataFrame:
    """Paths that occur more than once in a domain: their documents would share a key."""
    return (
        specs.groupBy("domain", "path").agg(F.count(F.lit(1)).alias("uses")).filter(F.col("uses") > 1)
    )
