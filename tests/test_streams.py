import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluiceway.config import ResponseFeed
from sluiceway.plans import gold
from sluiceway.sources.landing import LANDING_SCHEMA, append_landing
from sluiceway.streaming import responses as stream
from sluiceway.streaming.count_view import CountView
from sluiceway.streaming.events import read_events
from sluiceway.streaming.keyed_table import KeyedTable


def land(spark, feed, rows):
    values = [
        (endpoint, endpoint.strip("/"), status, body, None if body else "HTTP", run, 1, at)
        for endpoint, status, body, run, at in rows
    ]
    ddl = "endpoint string, url string, status_code int, response_body string, error_message string, run_id string, attempts int, at string"
    df = spark.createDataFrame(values, ddl).withColumn("fetched_at", F.to_timestamp("at")).drop("at")
    append_landing(df.select(*LANDING_SCHEMA.names).coalesce(1), feed.landing)


FIRST = [
    ("/posts", 200, '[{"id":1,"v":"a"},{"id":2,"v":"a"},{"v":"no id"}]', "r1", "2024-03-01 10:00:00"),
    ("/users", 200, '{"id":1,"v":"u"}', "r1", "2024-03-01 10:00:00"),
    ("/users", 404, None, "r1", "2024-03-01 10:00:01"),
    ("/posts", 200, "broken", "r1", "2024-03-01 10:00:02"),
]
SECOND = [
    ("/posts", 200, '[{"id":2,"v":"b"},{"id":3,"v":"b"}]', "r2", "2024-03-02 10:00:00"),
    ("/users", 200, '{"id":1,"v":"late"}', "r0", "2024-02-28 10:00:00"),
]


def feed_at(tmp_path, shape="records"):
    return ResponseFeed(str(tmp_path / "landing"), str(tmp_path / "tables"), shape, buckets=4)


def records(table):
    return {
        (r["endpoint"], r["record_id"]): r["record_json"] for r in table.read().collect()
    }


def test_records_converge_over_triggers(spark, tmp_path):
    feed = feed_at(tmp_path)
    land(spark, feed, FIRST)
    table = stream.update(spark, feed)
    assert set(records(table)) == {("/posts", "1"), ("/posts", "2"), ("/users", "1")}
    land(spark, feed, SECOND)
    table = stream.update(spark, feed)
    assert records(table) == {
        ("/posts", "1"): '{"id":"1","v":"a"}', ("/posts", "2"): '{"id":"2","v":"b"}',
        ("/posts", "3"): '{"id":"3","v":"b"}', ("/users", "1"): '{"id":"1","v":"u"}',
    }
    version = table.version()
    assert stream.update(spark, feed).version() == version
    bronze = stream.read_bronze(spark, feed)
    assert bronze.count() == 6
    health = {r["endpoint"]: r for r in gold.endpoint_health(bronze).collect()}
    assert (health["/users"]["total_calls"], health["/users"]["error_count"]) == (3, 1)
    events = read_events(spark, f"{feed.base}/quality_events")
    counted = {(r[0], r[1]): (r[2], r[3]) for r in events.groupBy("table", "expectation").agg(F.sum("rows"), F.sum("violations")).collect()}
    assert counted[("silver_api_records", "has_record_key")] == (7, 1)
    assert counted[("bronze_api_responses", "unparseable_responses")] == (6, 1)


def test_documents_keep_one_row_per_run(spark, tmp_path):
    feed = feed_at(tmp_path, "document")
    land(spark, feed, FIRST + SECOND)
    land(spark, feed, [("/posts", 200, '{"again":true}', "r1", "2024-03-01 11:00:00")])
    table = stream.update(spark, feed)
    rows = {(r["endpoint"], r["run_id"]): r["response_body"] for r in table.read().collect()}
    assert set(rows) == {("/posts", "r1"), ("/users", "r1"), ("/posts", "r2"), ("/users", "r0")}
    assert rows[("/posts", "r1")] == '{"again":true}'
    assert table.read().selectExpr("response_variant:again::boolean AS a").filter("a").count() == 1


def test_a_restart_after_the_state_but_before_the_checkpoint(spark, tmp_path, monkeypatch):
    feed = feed_at(tmp_path)
    land(spark, feed, FIRST)
    whole = KeyedTable.upsert

    def then_die(self, *args, **kind):
        whole(self, *args, **kind)
        raise RuntimeError("lost after commit")

    monkeypatch.setattr(KeyedTable, "upsert", then_die)
    with pytest.raises(Exception, match="lost after commit"):
        stream.update(spark, feed)
    monkeypatch.undo()
    version = stream.silver_table(spark, feed).version()
    table = stream.update(spark, feed)
    assert table.version() == version and len(records(table)) == 3


def test_unknown_shape_is_refused():
    with pytest.raises(ValueError):
        ResponseFeed("a", "b", "table")


moves = st.lists(
    st.lists(st.tuples(st.integers(1, 6), st.integers(1, 60), st.integers(1, 3), st.sampled_from("uuud")), max_size=8),
    min_size=1, max_size=3,
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(moves)
def test_incremental_counts_equal_a_full_count(spark, tmp_path_factory, batches):
    table = KeyedTable(spark, str(tmp_path_factory.mktemp("counts") / "t"), ["record"], ["seq"], buckets=2, max_deltas=1)
    view = CountView(spark, str(tmp_path_factory.mktemp("counts") / "v"), table, ["ingest_date", "endpoint"])
    for number, batch in enumerate(batches):
        rows = spark.createDataFrame(batch, "record int, seq int, ingest_date int, op string")
        table.upsert(rows.withColumn("endpoint", F.lit("/e")), "q", number, "op = 'd'")
        counts = view.refresh()
        assert view.version() == table.version()
        full = gold.records_per_day(table.read())
        assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, full.collect()))


def test_counts_start_over_when_their_version_has_expired(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["record"], ["seq"], buckets=2)
    view = CountView(spark, str(tmp_path / "v"), table, ["day"])
    for number in range(3):
        table.upsert(spark.createDataFrame([(number, 1, number % 2)], "record int, seq int, day int"), "q", number)
        if number == 0:
            view.refresh()
    table.expire(keep=1)
    assert {r["day"]: r["record_count"] for r in view.refresh().collect()} == {0: 2, 1: 1}


def test_every_batch_is_counted_even_those_a_query_forgets(spark, tmp_path):
    feed = feed_at(tmp_path)
    for i in range(7):
        land(spark, feed, [("/posts", 200, f'[{{"id":{i}}}]', f"r{i}", "2024-03-01 10:00:00")])
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        stream.update(spark, feed, max_files=1)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    events = read_events(spark, f"{feed.base}/quality_events").filter("`table` = 'bronze_api_responses' AND expectation = 'has_endpoint'")
    assert events.agg(F.sum("rows")).first()[0] == stream.read_bronze(spark, feed).count() == 7


def test_a_column_added_at_landing_reaches_bronze(spark, tmp_path):
    feed = feed_at(tmp_path)
    land(spark, feed, FIRST)
    stream.update(spark, feed)
    rows = spark.read.parquet(feed.landing).limit(1).withColumn("run_id", F.lit("r9")).withColumn("region", F.lit("eu"))
    append_landing(rows, feed.landing)
    stream.update(spark, feed)
    found = {r["run_id"]: r["region"] for r in stream.read_bronze(spark, feed).select("run_id", "region").collect()}
    assert found == {"r1": None, "r9": "eu"}
