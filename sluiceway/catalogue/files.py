"""Queries over dropped files."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.catalogue.registry import query, table
from sluiceway.config import FileFeed
from sluiceway.operators import quality
from sluiceway.operators.changes import current_state
from sluiceway.plans import gold
from sluiceway.plans.tables import clustered, space_filled
from sluiceway.session import scratch_path
from sluiceway.sources.files import conform
from sluiceway.sources.synthetic import demo_orders, read_drops, write_one_file
from sluiceway.streaming import files as stream

AS_OF = "2001-08-01"

_COLUMNS = (
    "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
    "concat('b', o_orderkey % 7) AS source_file",
    "1000 + 10 * (o_orderkey % 7) AS source_file_size",
    "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(CAST(o_orderkey % 7 AS INT)) AS source_file_modified_at",
    "o_orderdate AS _ingested_at",
    "to_date(o_orderdate) AS ingest_date",
    "CASE WHEN o_orderkey % 11 = 0 THEN '{\"o_comment\":\"x\"}' END AS _rescued_data",
)

FILES = """
WITH files AS (
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate,
    'b' || (o_orderkey % 7) AS source_file,
    1000 + 10 * (o_orderkey % 7) AS source_file_size,
    TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(o_orderkey % 7 AS INTEGER)) AS source_file_modified_at,
    o_orderdate AS _ingested_at,
    CAST(o_orderdate AS DATE) AS ingest_date,
    CASE WHEN o_orderkey % 11 = 0 THEN '{"o_comment":"x"}' END AS _rescued_data
  FROM orders
), silver AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM files)
  WHERE rn = 1
)
"""


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*_COLUMNS)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_state(bronze(spark, sf_dir), ["o_custkey"], ["o_orderdate", "o_orderkey"])


_HEALTH = """
SELECT ingest_date, count(DISTINCT source_file) AS files_ingested, count(*) AS rows_ingested,
  CAST(sum(source_file_size) AS BIGINT) AS total_bytes, max(source_file_modified_at) AS latest_source_file_at,
  max(_ingested_at) AS last_ingest_run_at
FROM files WHERE ingest_date >= DATE '2001-07-25' GROUP BY ingest_date
"""


@query(FILES + _HEALTH)
def files_ingestion_health(spark, sf_dir):
    return gold.files_health(bronze(spark, sf_dir), AS_OF)


@query(
    FILES
    + """
SELECT ingest_date, count(*) AS files_ingested, CAST(sum(n) AS BIGINT) AS rows_ingested,
  CAST(sum(row_bytes) AS BIGINT) AS total_bytes, max(modified) AS latest_source_file_at,
  max(ingested) AS last_ingest_run_at, CAST(sum(size) AS BIGINT) AS distinct_file_bytes
FROM (
  SELECT ingest_date, source_file, count(*) AS n, sum(source_file_size) AS row_bytes,
    max(source_file_size) AS size, max(source_file_modified_at) AS modified, max(_ingested_at) AS ingested
  FROM files WHERE ingest_date >= DATE '2001-07-25' GROUP BY ingest_date, source_file)
GROUP BY ingest_date
"""
)
def files_distinct_bytes(spark, sf_dir):
    return gold.files_health(bronze(spark, sf_dir), AS_OF, corrected=True)


@query(FILES + "SELECT ingest_date, count(*) AS record_count FROM silver GROUP BY ingest_date")
def files_rows_per_day(spark, sf_dir):
    return gold.rows_per_day(_silver(spark, sf_dir))


@query(FILES + "SELECT ingest_date, count(*) AS record_count FROM files GROUP BY ingest_date")
def files_rows_per_day_passthrough(spark, sf_dir):
    return gold.rows_per_day(bronze(spark, sf_dir))


@query(FILES + "SELECT * FROM silver")
def files_silver_dedup(spark, sf_dir):
    return _silver(spark, sf_dir)


@query(FILES + "SELECT * FROM files")
def files_silver_passthrough(spark, sf_dir):
    """Every row kept; the expectation only warns."""
    return quality.drop_violations(bronze(spark, sf_dir), quality.SILVER_FILES)


@query(
    FILES
    + """
SELECT 'silver_cloud_files' AS "table", 'no_schema_drift' AS expectation, 'warn' AS action,
  CAST(0 AS BIGINT) AS batch_id, count(*) AS "rows", count(_rescued_data) AS violations FROM files
"""
)
def files_expectations(spark, sf_dir):
    return quality.report(bronze(spark, sf_dir), "silver_cloud_files", quality.SILVER_FILES)


@query(FILES + "SELECT count(*) AS rows_seen, count(DISTINCT source_file) AS files_seen FROM files")
def files_adhoc_counts(spark, sf_dir):
    return bronze(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("rows_seen"), F.count_distinct("source_file").alias("files_seen")
    )


@query(
    """
SELECT p_partkey, TRY_CAST(raw AS INTEGER) AS p_size, p_brand,
  CASE WHEN TRY_CAST(raw AS INTEGER) IS NULL THEN '{"p_size":"' || raw || '"}' END AS _rescued_data
FROM (SELECT *, CASE WHEN p_partkey % 7 = 0 THEN p_type ELSE CAST(p_size AS VARCHAR) END AS raw FROM part)
"""
)
def files_rescued(spark, sf_dir):
    """Text where a number is registered: the row stays, the text is rescued."""
    raw = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "CASE WHEN p_partkey % 7 = 0 THEN p_type ELSE CAST(p_size AS STRING) END AS p_size", "p_brand"
    )
    return conform(raw, T.StructType.fromDDL("p_partkey bigint, p_size int, p_brand string"))


@query("SELECT * FROM orders")
def clustered_layout(spark, sf_dir):
    return clustered(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderdate"])


@query('SELECT count(*) AS "rows", CAST(0 AS BIGINT) AS overlapping_files FROM orders')
def clustered_file_ranges(spark, sf_dir):
    """Files written in that layout whose range reaches into the next file's; a shared edge value does not count."""
    path = scratch_path(spark, "clustered")
    clustered(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderdate"]).write.parquet(path)
    place = F.struct("o_orderstatus", "o_orderdate")
    ranges = (
        spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("low"), F.max(place).alias("high"))
    )
    following = F.lead("low").over(Window.orderBy("low", "high"))  # one row per file
    marked = ranges.withColumn("overlaps", F.coalesce(F.col("high") > following, F.lit(False)))
    return marked.agg(F.sum("n").alias("rows"), F.count_if("overlaps").alias("overlapping_files"))


@query(
    """
SELECT 'o_custkey' AS by_column, count(*) AS "rows", TRUE AS few_files FROM orders WHERE o_custkey = (SELECT min(o_custkey) FROM orders)
UNION ALL
SELECT 'o_orderdate', count(*), TRUE FROM orders WHERE o_orderdate = (SELECT min(o_orderdate) FROM orders)
"""
)
def space_filling_layout(spark, sf_dir):
    """Of 64 files in that layout, those that a filter on either column has to open: near the square root."""
    path, files = scratch_path(spark, "curve"), 64
    orders = table(spark, sf_dir, "orders")
    space_filled(orders, ["o_custkey", "o_orderdate"], files).write.parquet(path)
    stored, found = spark.read.parquet(path), None
    for column in ("o_custkey", "o_orderdate"):
        per_file = stored.groupBy(F.col("_metadata.file_path")).agg(F.min(column).alias("low"), F.max(column).alias("high"))
        wanted = orders.select(F.min(column).alias("value"))
        touched = per_file.join(wanted, F.col("value").between(F.col("low"), F.col("high"))).agg(F.count(F.lit(1)).alias("touched"))
        rows = stored.join(wanted, F.col(column) == F.col("value")).agg(F.count(F.lit(1)).alias("rows"))
        part = rows.join(touched).select(F.lit(column).alias("by_column"), "rows", (F.col("touched") <= 3 * math.isqrt(files)).alias("few_files"))
        found = part if found is None else found.unionAll(part)
    return found


@query(
    """
WITH months AS (
  SELECT date_trunc('month', o_orderdate)::DATE AS month, count(DISTINCT o_custkey) AS customers, count(*) AS "rows"
  FROM orders GROUP BY ALL)
SELECT month, customers, "rows", TRUE AS estimate_is_near FROM months
"""
)
def distinct_counts_by_sketch(spark, sf_dir):
    """Customers by month out of sketches per day, beside the exact number: within 2 %."""
    orders = table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    path = scratch_path(spark, "sketches")
    gold.distinct_sketches(orders, ["day"], "o_custkey").write.parquet(path)
    month = F.trunc("day", "month").alias("month")
    near = gold.distinct_counts(spark.read.parquet(path).withColumn("month", month), ["month"])
    exact = orders.groupBy(month).agg(F.countDistinct("o_custkey").alias("customers"))
    within = F.abs(F.col("distinct_estimate") - F.col("customers")) * 50 <= F.col("customers")
    return exact.join(near, "month").select("month", "customers", "rows", within.alias("estimate_is_near"))


@query(
    """
SELECT o_orderkey + 1 AS order_id,
  CASE (o_orderkey + 1) % 4 WHEN 0 THEN 'north' WHEN 1 THEN 'south' WHEN 2 THEN 'east' ELSE 'west' END AS region,
  (o_orderkey + 1) * CAST(10.5 AS DOUBLE) AS amount, o_orderdate AS order_ts
FROM orders
"""
)
def synthetic_drop(spark, sf_dir):
    ids = table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 1).alias("id"), "o_orderdate")
    return demo_orders(ids, "id", F.col("o_orderdate"))


@query("SELECT * FROM orders WHERE o_orderkey % 3 <> 1")
def drops_by_path(spark, sf_dir):
    """Two of three drops by their paths; the folder names look like partitions and give no column."""
    base, orders = scratch_path(spark, "by-path"), table(spark, sf_dir, "orders")
    for number in range(3):
        orders.filter(F.col("o_orderkey") % 3 == number).write.parquet(f"{base}/drop={number}")
    return read_drops(spark, f"{base}/drop=0", f"{base}/drop=2")


@query('SELECT count(*) AS "rows" FROM nation WHERE n_regionkey <> 0')
def one_file_overwrite(spark, sf_dir):
    """A drop that replaces another one: a row for each file there is, so one row."""
    path, nation = scratch_path(spark, "one-file"), table(spark, sf_dir, "nation")
    for drop in (nation, nation.filter("n_regionkey <> 0")):
        write_one_file(drop, path)
    return read_drops(spark, path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows")).drop("file")


@query("SELECT o_orderkey, 'drop_' || (o_orderkey % 3) AS source_drop, TRUE AS size_and_time_agree FROM orders")
def files_lineage(spark, sf_dir):
    """Where each bronze row came from, held against a listing of the dropped files."""
    base = scratch_path(spark, "lineage")
    feed = FileFeed(f"{base}/drops", base)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    for number in range(3):
        orders.filter(F.col("o_orderkey") % 3 == number).write.parquet(f"{feed.source}/drop_{number}")
    rows = stream.update(spark, feed).bronze()
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(feed.source)
    listing = listing.select(F.element_at(F.split("path", "/"), -1).alias("name"), "modificationTime", "length")
    agree = (F.col("length") == F.col("source_file_size")) & (F.col("modificationTime") == F.col("source_file_modified_at"))
    return rows.withColumn("name", F.element_at(F.split("source_file", "/"), -1)).join(listing, "name").select(
        "o_orderkey", F.regexp_extract("source_file", "/(drop_[0-9]+)/", 1).alias("source_drop"), agree.alias("size_and_time_agree")
    )


_DRIFTED = """
SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderkey % 3 < 2 OR o_totalprice = floor(o_totalprice) THEN o_totalprice END AS o_totalprice,
  CASE WHEN o_orderkey % 3 = 1 THEN o_orderpriority END AS o_orderpriority,
  CASE WHEN o_orderkey % 3 = 2 THEN '{"o_totalprice":"' || o_orderstatus || '"}' END AS _rescued_data
FROM (SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE o_totalprice END AS o_totalprice) FROM orders)
"""


@query("SELECT o_orderkey, o_custkey, o_orderkey % 20 AS part FROM orders")
def files_discovered_by_digest(spark, sf_dir):
    """Three runs over a folder that grows, ten files a batch; what was seen is a table of digests."""
    base = scratch_path(spark, "digests")
    feed = FileFeed(f"{base}/drops", base, max_files=10)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", (F.col("o_orderkey") % 20).alias("part"))
    for first, last in ((0, 4), (5, 5), (6, 19)):
        some = rows.filter(F.col("part").between(first, last)).withColumn("day", F.col("part") % 4)
        some.repartition(2).write.mode("append").partitionBy("day").parquet(feed.source)
        tables = stream.update_listed(spark, feed)
    return tables.bronze().select("o_orderkey", "o_custkey", "part")


@query(_DRIFTED)
def stream_files_incremental(spark, sf_dir):
    """Three triggers: the second brings a new column, the third a column of another type."""
    base = scratch_path(spark, "files")
    feed = FileFeed(f"{base}/drops", base)
    orders = table(spark, sf_dir, "orders")
    drops = [
        orders.filter("o_orderkey % 3 = 0").select("o_orderkey", "o_custkey", "o_totalprice"),
        orders.filter("o_orderkey % 3 = 1").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"),
        orders.filter("o_orderkey % 3 = 2").select(
            "o_orderkey", "o_custkey", F.col("o_orderstatus").alias("o_totalprice")
        ),
    ]
    for number, drop in enumerate(drops):
        drop.write.parquet(f"{feed.source}/drop_{number}")
        tables = stream.update(spark, feed)
    return tables.bronze().select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "_rescued_data")


@query(
    """
SELECT p_partkey,
  CASE WHEN p_partkey % 2 = 0 OR p_partkey % 7 <> 1 THEN CAST(p_size AS BIGINT) END AS p_size,
  p_retailprice,
  CASE WHEN p_partkey % 2 = 1 THEN p_brand END AS p_brand,
  CASE WHEN p_partkey % 2 = 1 AND p_partkey % 7 = 1 THEN '{"p_size":"' || p_type || '"}' END AS _rescued_data
FROM part
"""
)
def stream_files_json(spark, sf_dir):
    """JSON drops with inferred types; the second adds a column and holds text among numbers."""
    return _text_feed(spark, sf_dir, "json")


@query(
    """
SELECT p_partkey,
  CASE WHEN p_partkey % 2 = 0 OR p_partkey % 7 <> 1 THEN CAST(p_size AS INTEGER) END AS p_size,
  p_retailprice,
  CASE WHEN p_partkey % 2 = 1 THEN p_brand END AS p_brand,
  CASE WHEN p_partkey % 2 = 1 AND p_partkey % 7 = 1 THEN '{"p_size":"' || p_type || '"}' END AS _rescued_data
FROM part
"""
)
def stream_files_csv(spark, sf_dir):
    """The same with CSV drops, whose second header has other columns."""
    return _text_feed(spark, sf_dir, "csv")


def _text_feed(spark: SparkSession, sf_dir: str, file_format: str) -> DataFrame:
    base = scratch_path(spark, file_format)
    feed = FileFeed(f"{base}/drops", base, file_format)
    part = table(spark, sf_dir, "part")
    first = part.filter("p_partkey % 2 = 0").select("p_partkey", "p_size", "p_retailprice")
    second = part.filter("p_partkey % 2 = 1").select(
        "p_partkey", "p_brand",
        F.when(F.col("p_partkey") % 7 == 1, F.col("p_type")).otherwise(F.col("p_size").cast("string")).alias("p_size"),
        "p_retailprice",
    )
    for number, drop in enumerate((first, second)):
        writer = drop.write.option("header", "true") if file_format == "csv" else drop.write
        writer.format(file_format).save(f"{feed.source}/drop_{number}")
        tables = stream.update(spark, feed)
    columns = ["p_partkey", "p_size", "p_retailprice", "p_brand", "_rescued_data"]
    rows = tables.bronze().select(*columns)
    return rows.withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


@query(
    """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1
"""
)
def stream_files_dedup(spark, sf_dir):
    """Drops that overlap, deduplicated to one current row per key."""
    base = scratch_path(spark, "dedup")
    feed = FileFeed(f"{base}/drops", base, dedup_keys="o_custkey", dedup_order_by="o_orderkey", buckets=8)
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    for number, drop in enumerate((orders.filter("o_orderkey % 4 > 0"), orders.filter("o_orderkey % 4 < 2"))):
        drop.write.parquet(f"{feed.source}/drop_{number}")
        tables = stream.update(spark, feed)
    return tables.silver().select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
