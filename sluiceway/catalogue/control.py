"""Queries over an endpoint control table derived from ``customer``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.catalogue.registry import query, table
from sluiceway.plans.control import (
    compile_domains,
    compile_specs,
    compile_stats,
    duplicate_endpoints,
    endpoint_parameters,
)
from sluiceway.session import scratch_path
from sluiceway.sources.control import (
    control_slice,
    read_control_csv,
    read_control_table,
    specs_from_json,
    specs_from_list,
    with_control_columns,
)

# Read by both engines; TEXT and WHOLE stand for their type names. A domain holds the endpoints of
# twenty customers, so no domain grows with the data.
_COLUMNS = (
    "c_custkey AS row_no",
    """CASE WHEN c_custkey % 37 = 0 THEN '  '
         ELSE ' d' || CAST(CAST(floor(c_custkey / 20) AS WHOLE) AS TEXT) END AS domain""",
    "c_name AS endpoint_name",
    """CASE WHEN c_custkey % 41 = 0 THEN '' WHEN c_custkey % 7 = 0 THEN '/shared'
         ELSE '/' || lower(c_mktsegment) || '/' || CAST(c_custkey AS TEXT) END AS path""",
    """CASE WHEN floor(c_custkey / 20) % 3 = 0 THEN 'get' WHEN c_custkey % 5 = 0 THEN 'post '
         WHEN c_custkey % 5 = 1 THEN ' ' WHEN c_custkey % 5 = 2 THEN NULL ELSE 'GET' END AS method""",
    "CASE WHEN c_custkey % 3 = 0 THEN 'page=' || CAST(c_nationkey AS TEXT) END AS params",
    """CASE WHEN c_custkey % 4 <> 0
         THEN '0 0 ' || CAST(CAST(floor(c_custkey / 10) % 2 AS WHOLE) AS TEXT) || ' * * ?' END AS schedule""",
    """CASE c_custkey % 6 WHEN 0 THEN 'true' WHEN 1 THEN 'Yes' WHEN 2 THEN '0' WHEN 3 THEN ' T '
         WHEN 4 THEN 'no' ELSE '1' END AS enabled""",
    """CASE WHEN floor(c_custkey / 20) % 3 = 0 THEN ''
         WHEN c_custkey % 10 = 0 THEN '{"k":' || CAST(c_nationkey AS TEXT) || '}'
         WHEN c_custkey % 10 = 5 THEN 'not json' END AS body""",
    "CASE c_custkey % 8 WHEN 0 THEN 'Basic_Secret' WHEN 4 THEN 'connection' END AS auth_mode",
    "CASE c_custkey % 9 WHEN 0 THEN 'Document' WHEN 3 THEN 'other' END AS silver_shape",
)


def _columns(text: str, whole: str) -> list[str]:
    return [c.replace("TEXT", text).replace("WHOLE", whole) for c in _COLUMNS]


def control(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").selectExpr(*_columns("STRING", "BIGINT"))
    return with_control_columns(rows)


_SQL_ROWS = "SELECT " + ", ".join(_columns("VARCHAR", "BIGINT")) + " FROM customer"

CONTROL = f"""
WITH control AS ({_SQL_ROWS}
), usable AS (
  SELECT * REPLACE (trim(domain) AS domain, trim(path) AS path),
    lower(trim(enabled)) IN ('true', 't', '1', 'yes', 'y') AS is_enabled,
    CASE WHEN coalesce(trim(method), '') = '' THEN 'GET' ELSE upper(trim(method)) END AS verb
  FROM control WHERE trim(domain) <> '' AND trim(path) <> ''
), specs AS (
  SELECT row_no, domain, endpoint_name,
    CASE WHEN coalesce(params, '') <> '' THEN path || '?' || params ELSE path END AS path,
    verb AS method,
    CASE WHEN coalesce(body, '') = '' THEN NULL WHEN json_valid(body) THEN body ELSE '"' || body || '"' END AS body,
    schedule,
    nullif(lower(auth_mode), 'connection') AS auth_mode,
    nullif(lower(silver_shape), 'records') AS silver_shape
  FROM usable WHERE is_enabled
)
"""


@query(CONTROL + "SELECT * FROM specs")
def control_specs(spark, sf_dir):
    return compile_specs(control(spark, sf_dir))


@query(CONTROL + "SELECT * EXCLUDE (row_no) FROM specs")
def control_from_csv(spark, sf_dir):
    """The control table written out as CSV and read back."""
    path = scratch_path(spark, "control")
    writer = control(spark, sf_dir).drop("row_no").write.option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return compile_specs(read_control_csv(spark, path)).drop("row_no")


@query(CONTROL + "SELECT * EXCLUDE (row_no) FROM specs")
def control_from_table(spark, sf_dir):
    """The control table read by its name, its columns in another order."""
    rows = control(spark, sf_dir)
    rows.select(*sorted(rows.columns)).createOrReplaceTempView("sluiceway_control")
    return compile_specs(read_control_table(spark, "sluiceway_control", "row_no")).drop("row_no")


@query(
    CONTROL
    + """
SELECT domain, count(*) AS endpoints,
  count(*) FILTER (WHERE method <> 'GET' OR body IS NOT NULL) AS non_get_endpoints,
  coalesce(arg_min(schedule, row_no) FILTER (WHERE schedule IS NOT NULL), '') AS schedule,
  coalesce(arg_min(auth_mode, row_no) FILTER (WHERE auth_mode IS NOT NULL), 'connection') AS auth_mode,
  coalesce(arg_min(silver_shape, row_no) FILTER (WHERE silver_shape IS NOT NULL), 'records') AS silver_shape,
  count(DISTINCT schedule) > 1 AS schedule_conflict,
  count(DISTINCT auth_mode) > 1 AS auth_mode_conflict,
  count(DISTINCT silver_shape) > 1 AS silver_shape_conflict
FROM specs GROUP BY domain
"""
)
def control_compile(spark, sf_dir):
    return compile_domains(compile_specs(control(spark, sf_dir)))


@query(
    CONTROL
    + """
SELECT domain,
  CASE WHEN bool_and(method = 'GET' AND body IS NULL) THEN string_agg(path, ',' ORDER BY row_no) END AS api_endpoints,
  CASE WHEN NOT bool_and(method = 'GET' AND body IS NULL) THEN '[' || string_agg(
    '{"path":"' || path || '","method":"' || method || '"' || coalesce(',"body":' || body, '') || '}',
    ',' ORDER BY row_no) || ']' END AS api_endpoints_json
FROM specs GROUP BY domain
"""
)
def control_parameters(spark, sf_dir):
    return endpoint_parameters(compile_specs(control(spark, sf_dir)))


@query(
    CONTROL
    + """
SELECT (SELECT count(*) FROM control) AS "rows",
  (SELECT count(*) FROM specs) AS enabled_endpoints,
  (SELECT count(DISTINCT domain) FROM specs) AS domains,
  (SELECT count(*) FROM usable WHERE NOT is_enabled) AS skipped_disabled,
  (SELECT count(*) FROM specs WHERE method <> 'GET' OR body IS NOT NULL) AS non_get_endpoints
"""
)
def control_stats(spark, sf_dir):
    return compile_stats(control(spark, sf_dir))


@query(CONTROL + "SELECT domain, path, count(*) AS uses FROM specs GROUP BY ALL HAVING count(*) > 1")
def control_duplicates(spark, sf_dir):
    return duplicate_endpoints(compile_specs(control(spark, sf_dir)))


@query(
    """
SELECT c_custkey AS row_no, c_mktsegment AS domain, '/' || c_name AS path FROM customer
WHERE c_custkey % 3 > 0 AND c_mktsegment = 'BUILDING'
"""
)
def control_slice_at_runtime(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS row_no", "c_mktsegment AS domain", "concat('/', c_name) AS path",
        "c_custkey % 3 > 0 AS enabled",
    )
    return control_slice(rows, "BUILDING").drop("enabled")


@query(
    """
SELECT c_custkey, '/a/' || c_custkey AS path, 'GET' AS method FROM customer
UNION ALL SELECT c_custkey, '/b?n=' || c_nationkey, 'GET' FROM customer WHERE c_custkey % 2 = 0
"""
)
def request_specs_list(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "concat(' /a/', c_custkey, ', ,', CASE WHEN c_custkey % 2 = 0 THEN concat('/b?n=', c_nationkey) ELSE '' END) AS given",
    )
    return specs_from_list(rows, "given").select("c_custkey", "path", "method")


@query(
    """
SELECT c_custkey, '/c/' || c_custkey AS path, 'POST' AS method,
  '{"n":' || c_nationkey || ',"tags":["x"]}' AS body, 'v' || c_nationkey AS header, CAST(NULL AS VARCHAR) AS name
FROM customer
UNION ALL
SELECT c_custkey, '/d', NULL, '"plain"', NULL, c_name FROM customer
"""
)
def request_specs_json(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        """concat('[{"path":"/c/', c_custkey, '","method":"POST","body":{"n": ', c_nationkey,
             ', "tags": ["x"]},"headers":{"h":"v', c_nationkey, '"}}, {"path":"/d","body":"plain","name":"',
             c_name, '"}]') AS given""",
    )
    return specs_from_json(rows, "given").select(
        "c_custkey", "path", "method", "body", F.col("headers")["h"].alias("header"), "name"
    )
