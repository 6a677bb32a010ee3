"""Queries over API responses derived from ``events``."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.catalogue.registry import query, table
from sluiceway.config import DOCUMENT, ResponseFeed
from sluiceway.operators import quality
from sluiceway.operators.changes import current_state
from sluiceway.operators.parse import (
    enrich_responses,
    explode_records,
    explode_variant,
    select_documents,
    variant_field,
)
from sluiceway.plans import gold
from sluiceway.plans.tables import read_view, refresh_view
from sluiceway.session import scratch_path
from sluiceway.sources.fetch import fetch_responses, land_run, refused_runs, summarize_run
from sluiceway.sources.landing import LANDING_SCHEMA, append_landing, read_landing
from sluiceway.streaming import responses as stream
from sluiceway.streaming.count_view import CountView
from sluiceway.streaming.keyed_table import KeyedTable

AS_OF = "2024-01-30"
RECORD_KEYS, DOCUMENT_KEYS, SEQUENCE = ["endpoint", "record_id"], ["endpoint", "run_id"], ["fetched_at"]


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per event: every kind of status, and every kind of body.

    Of 20 events: a 404, a transport failure, a redirect, a body cut off or empty, an empty array,
    an object without id, two objects, a mixed array, and twelve arrays of two records.
    """
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "CASE WHEN event_id % 97 <> 96 THEN concat('/', event_type) END AS endpoint",
        "event_type AS url",
        "CASE event_id % 20 WHEN 0 THEN 404 WHEN 1 THEN NULL WHEN 2 THEN 302 ELSE 200 END AS status_code",
        """CASE event_id % 20
             WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL
             WHEN 3 THEN CASE WHEN event_id % 40 = 23 THEN '' ELSE '{"id": 1, "seen"' END
             WHEN 4 THEN '[]'
             WHEN 5 THEN props
             WHEN 6 THEN concat('{"id": ', user_id, ', "seen": ', event_id, ', "attrs": ', props, '}')
             WHEN 7 THEN concat('{"id": ', user_id, ', "seen": ', event_id, ', "attrs": ', props, '}')
             WHEN 8 THEN concat('[{"id": ', user_id, '}, 5]')
             ELSE concat('[{"id": ', user_id, ', "seen": ', event_id, ', "attrs": ', props,
                         '}, {"id": ', user_id + 100000, ', "seen": ', event_id, ', "label": "é€"}]')
           END AS response_body""",
        """CASE event_id % 20 WHEN 0 THEN 'HTTP 404: no such thing' WHEN 1 THEN 'TimeoutError()'
             WHEN 2 THEN 'HTTP 302: moved' END AS error_message""",
        "ts AS fetched_at",
        "concat('run-', date_format(ts, 'yyyyMMdd')) AS run_id",
    )


RESPONSES = """
WITH responses AS (
  SELECT event_id,
    CASE WHEN event_id % 97 <> 96 THEN '/' || event_type END AS endpoint,
    event_type AS url,
    CASE event_id % 20 WHEN 0 THEN 404 WHEN 1 THEN NULL WHEN 2 THEN 302 ELSE 200 END AS status_code,
    CASE event_id % 20
      WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL
      WHEN 3 THEN CASE WHEN event_id % 40 = 23 THEN '' ELSE '{"id": 1, "seen"' END
      WHEN 4 THEN '[]'
      WHEN 5 THEN props
      WHEN 6 THEN '{"id": ' || user_id || ', "seen": ' || event_id || ', "attrs": ' || props || '}'
      WHEN 7 THEN '{"id": ' || user_id || ', "seen": ' || event_id || ', "attrs": ' || props || '}'
      WHEN 8 THEN '[{"id": ' || user_id || '}, 5]'
      ELSE '[{"id": ' || user_id || ', "seen": ' || event_id || ', "attrs": ' || props
           || '}, {"id": ' || (user_id + 100000) || ', "seen": ' || event_id || ', "label": "é€"}]'
    END AS response_body,
    CASE event_id % 20 WHEN 0 THEN 'HTTP 404: no such thing' WHEN 1 THEN 'TimeoutError()'
      WHEN 2 THEN 'HTTP 302: moved' END AS error_message,
    ts AS fetched_at,
    'run-' || strftime(ts, '%Y%m%d') AS run_id,
    CAST(ts AS DATE) AS ingest_date
  FROM events
), bodies AS (
  SELECT *, CASE WHEN json_valid(response_body) THEN CAST(response_body AS JSON) END AS body FROM responses
), elements AS (
  SELECT *, CASE json_type(body)
      WHEN 'ARRAY' THEN CASE
        WHEN len(list_filter(json_extract(body, '$[*]'), lambda e: json_type(e) NOT IN ('OBJECT', 'NULL'))) = 0
        THEN json_extract(body, '$[*]') ELSE [] END
      WHEN 'OBJECT' THEN [body]
      ELSE [] END AS items
  FROM bodies
), records AS (
  SELECT event_id, endpoint, url, status_code, fetched_at, ingest_date, run_id,
    json_extract_string(item, '$.id') AS record_id,
    TRY_CAST(json_extract_string(item, '$.seen') AS BIGINT) AS seen,
    TRY_CAST(json_extract_string(item, '$.attrs.k') AS BIGINT) AS k,
    json_extract_string(item, '$.label') AS label
  FROM (SELECT *, unnest(items) AS item FROM elements)
), silver_records AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY endpoint, record_id ORDER BY fetched_at DESC, event_id DESC) AS rn
    FROM records
    WHERE status_code BETWEEN 200 AND 299 AND record_id IS NOT NULL AND endpoint IS NOT NULL)
  WHERE rn = 1
), silver_documents AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY endpoint, run_id ORDER BY fetched_at DESC, event_id DESC) AS rn
    FROM bodies
    WHERE body IS NOT NULL AND status_code BETWEEN 200 AND 299 AND endpoint IS NOT NULL)
  WHERE rn = 1
)
"""


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_responses(landing(spark, sf_dir), F.col("fetched_at"))


def _record_columns(rows: DataFrame) -> DataFrame:
    """Fields out of the record text, as a reader of silver takes them."""
    fields = rows.withColumn("record", F.from_json("record_json", "seen string, attrs string, label string"))
    return fields.select(
        "endpoint", "url", "status_code", "fetched_at", "ingest_date", "run_id", "record_id",
        F.col("record.seen").cast("bigint").alias("seen"),
        F.from_json("record.attrs", "k bigint")["k"].alias("k"),
        F.col("record.label").alias("label"),
    )


def _silver_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.drop_violations(explode_records(bronze(spark, sf_dir)), quality.SILVER_RECORDS)
    return current_state(rows, RECORD_KEYS, SEQUENCE)


def _silver_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.drop_violations(select_documents(bronze(spark, sf_dir)), quality.SILVER_DOCUMENTS)
    return current_state(rows, DOCUMENT_KEYS, SEQUENCE)


_HEALTH = """
  SELECT endpoint, max(fetched_at) AS last_fetched_at, count(*) AS total_calls,
    CAST(sum(CASE WHEN status_code BETWEEN 200 AND 299 THEN 1 ELSE 0 END) AS BIGINT) AS success_count,
    CAST(sum(CASE WHEN status_code BETWEEN 400 AND 599 THEN 1 ELSE 0 END) AS BIGINT) AS error_count,
    CAST(sum(CASE WHEN error_message IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS network_error_count,
    avg(length(response_body)) AS avg_body_bytes,
    {extra}
    CAST(sum(CASE WHEN status_code BETWEEN 200 AND 299 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS success_rate
  FROM responses WHERE ingest_date >= DATE '2024-01-23' GROUP BY endpoint
"""


@query(RESPONSES + _HEALTH.format(extra=""))
def api_endpoint_health(spark, sf_dir):
    return gold.endpoint_health(bronze(spark, sf_dir), AS_OF)


@query(
    RESPONSES
    + _HEALTH.format(
        extra="""CAST(sum(CASE WHEN error_message IS NOT NULL AND (status_code IS NULL OR status_code >= 500)
             THEN 1 ELSE 0 END) AS BIGINT) AS server_or_transport_error_count,
    avg(strlen(response_body)) AS avg_body_octets,"""
    )
)
def api_health_corrected(spark, sf_dir):
    return gold.endpoint_health(bronze(spark, sf_dir), AS_OF, corrected=True)


@query(RESPONSES + "SELECT * EXCLUDE (event_id) FROM records")
def api_records_exploded(spark, sf_dir):
    return _record_columns(explode_records(bronze(spark, sf_dir)))


@query(RESPONSES + "SELECT * EXCLUDE (event_id) FROM silver_records")
def api_silver_records(spark, sf_dir):
    return _record_columns(_silver_records(spark, sf_dir))


_DOCUMENTS = """
SELECT endpoint, url, status_code, fetched_at, ingest_date, run_id, response_body,
  TRY_CAST(json_extract_string(body, '$.attrs.k') AS INTEGER) AS k
FROM silver_documents
"""


def _document_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        "endpoint", "url", "status_code", "fetched_at", "ingest_date", "run_id", "response_body",
        variant_field("response_variant", "attrs.k", "int").alias("k"),
    )


@query(RESPONSES + _DOCUMENTS)
def api_silver_documents(spark, sf_dir):
    return _document_columns(_silver_documents(spark, sf_dir))


@query(RESPONSES + "SELECT ingest_date, endpoint, count(*) AS record_count FROM silver_records GROUP BY ALL")
def api_records_per_day(spark, sf_dir):
    return gold.records_per_day(_silver_records(spark, sf_dir))


@query(RESPONSES + "SELECT ingest_date, endpoint, count(*) AS record_count FROM silver_documents GROUP BY ALL")
def api_documents_per_day(spark, sf_dir):
    return gold.records_per_day(_silver_documents(spark, sf_dir))


@query(RESPONSES + "SELECT ingest_date, endpoint, count(*) AS record_count FROM silver_records GROUP BY ALL")
def api_records_per_day_incremental(spark, sf_dir):
    """Counts refreshed from the row-level changes of each of three batches, never recounted."""
    rows = quality.drop_violations(explode_records(bronze(spark, sf_dir)), quality.SILVER_RECORDS)
    base = scratch_path(spark, "records")
    silver = KeyedTable(spark, f"{base}/silver", RECORD_KEYS, SEQUENCE, buckets=8)
    view = CountView(spark, f"{base}/gold", silver, ["ingest_date", "endpoint"])
    day = F.dayofmonth("ingest_date")
    for batch, days in enumerate((day < 11, day.between(11, 20), day > 20)):
        silver.upsert(rows.filter(days), "incremental", batch)
        counts = view.refresh()
    return counts


@query(
    RESPONSES
    + """
SELECT event_id,
  TRY_CAST(json_extract_string(body, '$.attrs.k') AS INTEGER) AS object_k,
  TRY_CAST(json_extract_string(body, '$.k') AS INTEGER) AS bare_k,
  TRY_CAST(json_extract_string(body, '$[0].attrs.k') AS BIGINT) AS first_k,
  json_extract_string(body, '$[1].label') AS second_label
FROM bodies WHERE body IS NOT NULL
"""
)
def variant_path(spark, sf_dir):
    return bronze(spark, sf_dir).filter(F.col("response_variant").isNotNull()).select(
        "event_id",
        variant_field("response_variant", "attrs.k", "int").alias("object_k"),
        variant_field("response_variant", "k", "int").alias("bare_k"),
        variant_field("response_variant", "$[0].attrs.k", "bigint").alias("first_k"),
        variant_field("response_variant", "$[1].label", "string").alias("second_label"),
    )


@query(
    RESPONSES
    + """
SELECT event_id, CAST(pos AS INTEGER) AS pos,
  TRY_CAST(json_extract_string(item, '$.id') AS BIGINT) AS id,
  TRY_CAST(json_extract_string(item, '$.attrs.k') AS BIGINT) AS k
FROM (
  SELECT event_id, unnest(json_extract(body, '$[*]')) AS item,
    unnest(range(CAST(json_array_length(body) AS BIGINT))) AS pos
  FROM bodies WHERE json_type(body) = 'ARRAY')
"""
)
def variant_explode_rows(spark, sf_dir):
    bodies = bronze(spark, sf_dir).select("event_id", "response_variant")
    return (
        explode_variant(bodies, "response_variant")
        .filter(F.col("pos").isNotNull() & F.col("key").isNull())  # the fields of an object have a key
        .select(
            "event_id", "pos",
            variant_field("value", "id", "bigint").alias("id"),
            variant_field("value", "attrs.k", "bigint").alias("k"),
        )
    )


def _lines(source: str, table_name: str, rules) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{table_name}' AS \"table\", '{r.name}' AS expectation, '{r.action}' AS action, "
        f"CAST(0 AS BIGINT) AS batch_id, count(*) AS \"rows\", "
        f"count(*) FILTER (WHERE ({condition}) IS NOT TRUE) AS violations FROM {source}"
        for r, condition in rules
    )


@query(
    RESPONSES
    + "\nUNION ALL\n".join(
        [
            _lines(
                "responses", "bronze_api_responses",
                [
                    (quality.BRONZE_RESPONSES[0], "endpoint IS NOT NULL"),
                    (quality.BRONZE_RESPONSES[1], "response_body IS NULL OR length(response_body) > 0"),
                ],
            ),
            _lines(
                "records", "silver_api_records",
                [
                    (quality.SILVER_RECORDS[0], "status_code BETWEEN 200 AND 299"),
                    (quality.SILVER_RECORDS[1], "record_id IS NOT NULL"),
                    (quality.SILVER_RECORDS[2], "TRUE"),
                ],
            ),
            _lines(
                "(SELECT * FROM bodies WHERE body IS NOT NULL)", "silver_api_documents",
                [
                    (quality.SILVER_DOCUMENTS[0], "status_code BETWEEN 200 AND 299"),
                    (quality.SILVER_DOCUMENTS[1], "body IS NOT NULL"),
                ],
            ),
        ]
    )
)
def expectations_report(spark, sf_dir):
    rows = bronze(spark, sf_dir)
    return (
        quality.report(rows, "bronze_api_responses", quality.BRONZE_RESPONSES)
        .unionByName(quality.report(explode_records(rows), "silver_api_records", quality.SILVER_RECORDS))
        .unionByName(quality.report(select_documents(rows), "silver_api_documents", quality.SILVER_DOCUMENTS))
    )


@query(
    """
WITH bodies AS (
  SELECT 'events' AS origin, props AS body FROM events
  UNION ALL SELECT 'documents', text FROM documents
  UNION ALL SELECT 'pages', html FROM pages
  UNION ALL SELECT 'conversations', text FROM conversations)
SELECT origin, count(*) AS "rows", count(*) FILTER (WHERE body IS NOT NULL AND NOT json_valid(body)) AS violations
FROM bodies GROUP BY origin
"""
)
def unparseable_bodies(spark, sf_dir):
    """Bodies that are not JSON, over all text there is."""
    parts = [("events", "props"), ("documents", "text"), ("pages", "html"), ("conversations", "text")]
    bodies = None
    for origin, column in parts:
        part = table(spark, sf_dir, origin).select(
            F.lit(origin).alias("origin"), F.col(column).alias("response_body")
        )
        bodies = part if bodies is None else bodies.unionByName(part)
    return bodies.groupBy("origin").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~quality.UNPARSEABLE.holds()).alias("violations")
    )


@query(
    RESPONSES
    + """
SELECT run_id, count(*) AS responses,
  count(*) FILTER (WHERE status_code BETWEEN 200 AND 299) AS success, min(error_message) AS an_error
FROM responses GROUP BY run_id
"""
)
def fetch_run_summary(spark, sf_dir):
    return summarize_run(landing(spark, sf_dir))


@query(
    RESPONSES
    + """
SELECT 'run-' || (event_id // 2) AS run_id, count(*) AS responses, CAST(0 AS BIGINT) AS success,
  min(error_message) AS an_error
FROM responses GROUP BY ALL HAVING count(*) FILTER (WHERE status_code BETWEEN 200 AND 299) = 0
"""
)
def fetch_refused_runs(spark, sf_dir):
    """Runs of two requests each; those of which none succeeded must not land."""
    pairs = F.concat(F.lit("run-"), F.floor(F.col("event_id") / 2).cast("string"))
    return refused_runs(landing(spark, sf_dir).withColumn("run_id", pairs))


@query(RESPONSES + "SELECT count(*) AS records FROM responses WHERE run_id = 'run-20240115'")
def run_verify(spark, sf_dir):
    return landing(spark, sf_dir).filter(F.col("run_id") == "run-20240115").agg(
        F.count(F.lit(1)).alias("records")
    )


@query(
    RESPONSES
    + """
SELECT run_id, count(*) AS records, count(*) FILTER (WHERE status_code BETWEEN 200 AND 299) AS success
FROM responses WHERE run_id IN ('run-20240115', 'run-20240116') GROUP BY run_id
"""
)
def landed_runs(spark, sf_dir):
    """Two runs land one after the other; each is checked before, and read back and counted after."""
    base, rows, found = scratch_path(spark, "landed"), landing(spark, sf_dir), []
    for run_id in ("run-20240115", "run-20240116"):
        run = rows.filter(F.col("run_id") == run_id).withColumn("attempts", F.lit(1)).select(*LANDING_SCHEMA.names)
        found.append(land_run(run, run_id, f"{base}/staging/{run_id}", f"{base}/landing"))
    return spark.createDataFrame(found, "run_id string, records bigint, success bigint")


class EventService:
    """An in-memory service whose answer follows from the event in the path."""

    def __init__(self):
        self._failed = {}

    def __call__(self, method, path, body, headers):
        number = int(path.rpartition("/")[2])
        kind = number % 10
        if kind == 0:
            return 503, "busy"
        if kind == 1:
            raise ConnectionError("refused")
        if kind == 2:
            return 404, "nothing here " * 50
        if kind == 3:
            return 429, "slow down"
        if kind == 4 and self._failed.setdefault(path, 0) < 2:
            self._failed[path] += 1
            return 500, "again"
        self._failed.pop(path, None)
        return 200, f"{method} {number} {body or ''}"


def _no_wait(seconds: float) -> None:
    return None


def _event_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "concat('/events/', event_id) AS path",
        "CASE WHEN event_id % 2 = 0 THEN 'post' END AS method",
        "CASE WHEN event_id % 2 = 0 THEN props END AS body",
        "CAST(NULL AS map<string,string>) AS headers",
        "CASE WHEN event_id % 3 = 0 THEN event_type END AS name",
    )


_FETCHED = """
SELECT CASE WHEN event_id % 3 = 0 THEN event_type ELSE '/events/' || event_id END AS endpoint,
  'events/' || event_id AS url,
  CASE WHEN event_id % 10 IN (0, 1) THEN NULL WHEN event_id % 10 = 2 THEN 404 WHEN event_id % 10 = 3 THEN 429
    ELSE 200 END AS status_code,
  CASE WHEN event_id % 10 > 3 THEN CASE WHEN event_id % 2 = 0 THEN 'POST ' || event_id || ' ' || props
    ELSE 'GET ' || event_id || ' ' END END AS response_body,
  CASE event_id % 10
    WHEN 0 THEN 'TransientHttpError(''HTTP 503 on events/' || event_id || ''')'
    WHEN 1 THEN 'ConnectionError(''refused'')'
    WHEN 2 THEN 'HTTP 404: ' || substr(repeat('nothing here ', 50), 1, 500)
    WHEN 3 THEN 'HTTP 429: slow down' END AS error_message,
  'run-x' AS run_id,
  CAST(CASE WHEN event_id % 10 IN (0, 1) THEN 4 WHEN event_id % 10 = 4 THEN 3 ELSE 1 END AS INTEGER) AS attempts
FROM events
"""


def _fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The service is in memory and needs no protection, so every core may call it.
    everywhere = spark.sparkContext.defaultParallelism
    return fetch_responses(_event_specs(spark, sf_dir), EventService(), "run-x", everywhere, sleep=_no_wait)


@query(_FETCHED)
def fetch_fake_transport(spark, sf_dir):
    return _fetched(spark, sf_dir).drop("fetched_at")


@query(_FETCHED)
def fetch_and_land(spark, sf_dir):
    """Fetch once into staging, check the run, append to landing, read the landing table."""
    base = scratch_path(spark, "fetch")
    land_run(_fetched(spark, sf_dir), "run-x", f"{base}/staging", f"{base}/landing")
    return read_landing(spark, f"{base}/landing").drop("fetched_at")


@query(
    RESPONSES
    + """
SELECT event_id, endpoint, url, status_code, response_body, error_message, fetched_at, run_id,
  CASE WHEN event_id % 2 = 1 THEN CAST(1 AS INTEGER) END AS attempts
FROM responses
"""
)
def landing_append(spark, sf_dir):
    """Two writers append to landing, the second with one column more."""
    path = scratch_path(spark, "landing")
    rows = landing(spark, sf_dir)
    append_landing(rows.filter("event_id % 2 = 0"), path)
    append_landing(rows.filter("event_id % 2 = 1").withColumn("attempts", F.lit(1)), path)
    return read_landing(spark, path)


def _streamed(spark: SparkSession, sf_dir: str, shape: str) -> DataFrame:
    """Landing, bronze and silver as triggered streams with several micro-batches."""
    base = scratch_path(spark, "responses")
    feed = ResponseFeed(f"{base}/landing", base, shape, buckets=8)
    rows = landing(spark, sf_dir).drop("event_id")
    append_landing(rows, feed.landing)
    stamp = F.col("fetched_at")
    bronze_run = stream.start_bronze(spark, feed, rows.schema, stamp)
    bronze_run.awaitTermination()
    files = len(stream.read_bronze(spark, feed).inputFiles())
    stream.start_silver(spark, feed, max_files=math.ceil(files / 3)).awaitTermination()
    return stream.silver_table(spark, feed).read()


@query(RESPONSES + "SELECT * EXCLUDE (event_id) FROM silver_records")
def stream_bronze_to_silver(spark, sf_dir):
    return _record_columns(_streamed(spark, sf_dir, "records"))


@query(RESPONSES + _DOCUMENTS)
def stream_documents(spark, sf_dir):
    return _document_columns(_streamed(spark, sf_dir, DOCUMENT))


@query(RESPONSES + _HEALTH.format(extra=""))
def gold_refresh(spark, sf_dir):
    """A gold table recomputed in full, twice, laid out by its cluster column."""
    path, rows = scratch_path(spark, "gold"), bronze(spark, sf_dir)
    for seen in (rows.filter("endpoint IS NULL"), rows):
        refresh_view(gold.endpoint_health(seen, AS_OF), path, ["endpoint"])
    return read_view(spark, path)
