import json
import os

import pytest

from sluiceway.config import FileFeed, ResponseFeed
from sluiceway.plans.domains import records_per_day, run_files, run_responses
from sluiceway.plans.tables import read_view, refresh_view
from sluiceway.sources.control import specs_from_rows
from sluiceway.sources.relational import schema_specs
from sluiceway.sources.synthetic import seed_demo
from sluiceway.streaming import responses as stream

# A cube request of our own; only its shape (point of view, columns, rows, something nested) is that of the demo.
GRID = {
    "gridDefinition": {
        "suppressMissingBlocks": True,
        "pov": {"dimensions": ["Harbour", "Scenario"], "members": [["Lisbon"], ["Forecast"]]},
        "columns": [{"dimensions": ["Tide"], "members": [["Ebb", "Flood", "Slack"]]}],
        "rows": [{"dimensions": ["Vessel"], "members": [[kind]]} for kind in ("Barge", "Ferry", "Tug", "Yawl")],
        "nested": {"depth": [1, {"keel": None}]},
    }
}


def echo(method, path, body, headers):
    return 200, json.dumps({"json": json.loads(body)})


def catalogue_service(method, path, body, headers):
    if path == "broken":
        return 404, "none"
    count = {"posts": 100, "users": 10}[path]
    return 200, json.dumps([{"id": i, "name": f"{path}{i}"} for i in range(1, count + 1)])


def quiet(seconds):
    return None


def test_records_domain_twice(spark, tmp_path):
    feed = ResponseFeed(str(tmp_path / "landing"), str(tmp_path / "tables"), buckets=4)
    specs = specs_from_rows(spark, [{"path": "/posts"}, {"path": "/users"}, {"path": "/broken"}])
    for _ in range(2):
        assert run_responses(spark, feed, specs, catalogue_service, sleep=quiet)["success"] == 2
    view = records_per_day(spark, feed)
    assert {r["endpoint"]: r["record_count"] for r in view.read().collect()} == {"/posts": 100, "/users": 10}
    assert view.version() == view.table.version() and view.full().exceptAll(view.read()).count() == 0
    health = {r["endpoint"]: r for r in read_view(spark, f"{feed.base}/gold_api_endpoint_health").collect()}
    assert health["/posts"]["total_calls"] == 2 and health["/posts"]["success_rate"] == 1.0
    assert health["/broken"]["error_count"] == 2 and health["/broken"]["server_or_transport_error_count"] == 0


def test_document_domain_sends_and_receives_a_grid(spark, tmp_path):
    feed = ResponseFeed(str(tmp_path / "landing"), str(tmp_path / "tables"), "document", buckets=4)
    specs = specs_from_rows(spark, [{"path": "/post", "method": "POST", "body": GRID, "name": "grid"}])
    run_responses(spark, feed, specs, echo, sleep=quiet)
    documents = stream.silver_table(spark, feed).read()
    assert json.loads(documents.first()["response_body"])["json"] == GRID
    documents.createOrReplaceTempView("documents")
    rows = spark.sql(
        """SELECT d.response_variant:json.gridDefinition.suppressMissingBlocks::boolean AS suppress,
                  r.value:members[0][0]::string AS member
           FROM documents d, LATERAL variant_explode(d.response_variant:json.gridDefinition.rows) AS r"""
    ).collect()
    assert sorted(map(tuple, rows)) == [(True, kind) for kind in ("Barge", "Ferry", "Tug", "Yawl")]


def test_files_domain(spark, tmp_path):
    feed = FileFeed(str(tmp_path / "drops"), str(tmp_path / "tables"), dedup_keys="order_id", buckets=4)
    (tmp_path / "drops").mkdir()
    run_files(spark, feed)
    seed_demo(spark, feed.source)
    run_files(spark, feed)
    daily = spark.read.parquet(f"{feed.base}/gold_files_rows_per_day")
    assert daily.first()["record_count"] == 100
    assert read_view(spark, f"{feed.base}/gold_files_ingestion_health").first()["files_ingested"] == 2


def test_a_view_is_readable_while_and_after_a_refresh_fails(spark, tmp_path):
    path = str(tmp_path / "view")
    refresh_view(spark.range(3), path)
    seen = read_view(spark, path)
    broken = spark.range(5).selectExpr("IF(id = 4, raise_error('no'), id) AS id")
    with pytest.raises(Exception, match="no"):
        refresh_view(broken, path, ["id"])
    assert read_view(spark, path).count() == 3
    refresh_view(spark.range(7), path, ["id"])
    assert seen.count() == 3 and read_view(spark, path).count() == 7
    refresh_view(spark.range(0), path)
    refresh_view(spark.range(2), path)
    assert read_view(spark, path).count() == 2
    assert len([n for n in os.listdir(path) if n.startswith("rows-")]) == 2
    with pytest.raises(FileNotFoundError):
        read_view(spark, str(tmp_path / "none"))


def test_specs_of_a_whole_schema(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    for name in ("a", "b"):
        spark.range(1).write.mode("overwrite").option("path", str(tmp_path / name)).saveAsTable(f"shop.{name}")
    specs = schema_specs(spark, "shop", {"a": ["id"], "b": ["id"]})
    assert [s.name for s in specs] == ["a", "b"]
    spark.sql("DROP DATABASE shop CASCADE")
