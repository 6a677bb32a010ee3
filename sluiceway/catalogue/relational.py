"""Queries over relational tables and their changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluiceway.catalogue.registry import query, table
from sluiceway.operators.changes import (
    append_only,
    apply_hard_deletes,
    current_state,
    hard_deleted,
    history,
    open_versions,
    table_changes,
)
from sluiceway.operators.reconcile import bitmap_deleted, reconcile
from sluiceway.plans.relational import RelationalTarget, ingest_tables
from sluiceway.session import scratch_path
from sluiceway.sources.cursor_stream import stream_by_cursor
from sluiceway.sources.relational import (
    TableSpec,
    audit_cursor,
    change_feed,
    needs_resnapshot,
    pull,
    retained,
)
from sluiceway.streaming.history_table import StoredHistory
from sluiceway.streaming.keyed_table import KeyedTable

NEWEST = ["o_orderdate", "o_orderkey"]


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


def _latest(where: str = "TRUE", source: str = "orders") -> str:
    return f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM {source})
WHERE rn = 1 AND {where}
"""


@query("SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01 00:00:00'")
def cursor_pull(spark, sf_dir):
    mark = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    return pull(_orders(spark, sf_dir), "o_orderdate", mark)


@query("SELECT * FROM orders")
def full_reload(spark, sf_dir):
    return pull(_orders(spark, sf_dir), None)


@query(
    """
SELECT max(o_orderdate) AS watermark, count(*) AS pulled FROM orders
WHERE o_orderdate > TIMESTAMP '1998-01-01 00:00:00'
"""
)
def cursor_watermark(spark, sf_dir):
    return cursor_pull(spark, sf_dir).agg(
        F.max("o_orderdate").alias("watermark"), F.count(F.lit(1)).alias("pulled")
    )


@query(_latest())
def scd1_current_state(spark, sf_dir):
    return current_state(_orders(spark, sf_dir), ["o_custkey"], NEWEST)


_HISTORY = """
WITH chained AS (
  SELECT {key} AS key, o_orderkey, o_totalprice, o_orderstatus, o_orderkey AS valid_from,
    lead(o_orderkey) OVER (PARTITION BY {key} ORDER BY o_orderkey) AS valid_to
  FROM orders)
SELECT * FROM chained WHERE NOT (o_orderstatus = 'F' AND o_orderkey % 5 = 0)
"""


def _history(spark: SparkSession, sf_dir: str, key: str, **hot) -> DataFrame:
    changes = _orders(spark, sf_dir).select(
        F.col(key).alias("key"), "o_orderkey", "o_totalprice", "o_orderstatus"
    )
    return history(changes, ["key"], "o_orderkey", "o_orderstatus = 'F' AND o_orderkey % 5 = 0", **hot)


@query(_HISTORY.format(key="o_custkey"))
def scd2_history(spark, sf_dir):
    return _history(spark, sf_dir, "o_custkey")


@query(_HISTORY.format(key="o_orderpriority"))
def scd2_history_hot_keys(spark, sf_dir):
    """Few keys with a large part of the rows each: their histories are chained in pieces."""
    return _history(spark, sf_dir, "o_orderpriority", piece_rows=200)


_DAILY_HISTORY = """
WITH reduced AS (
  SELECT o_orderpriority AS key, CAST(o_orderdate AS DATE) AS day, max(o_orderkey % 7) AS grade
  FROM orders GROUP BY ALL)
SELECT key, grade, day AS valid_from, lead(day) OVER (PARTITION BY key ORDER BY day) AS valid_to FROM reduced
"""


@query(_DAILY_HISTORY)
def scd2_history_coarse_cursor(spark, sf_dir):
    """Few keys and a date as sequence: many equal changes at each of its values."""
    days = _orders(spark, sf_dir).select(
        F.col("o_orderpriority").alias("key"), F.to_date("o_orderdate").alias("day"), (F.col("o_orderkey") % 7).alias("grade")
    )
    top = F.max("grade").over(Window.partitionBy("key", "day"))
    return history(days.withColumn("grade", top), ["key"], "day", piece_rows=200).drop("day")


@query(_HISTORY.format(key="o_custkey"))
def scd2_history_spliced(spark, sf_dir):
    """Five batches in no order, spliced into a stored history."""
    changes = _orders(spark, sf_dir).select(F.col("o_custkey").alias("key"), "o_orderkey", "o_totalprice", "o_orderstatus")
    stored = StoredHistory(spark, scratch_path(spark, "history"), ["key"], "o_orderkey", buckets=4, period=20_000)
    for batch in range(5):
        part = changes.filter(F.pmod(F.xxhash64("o_orderkey"), F.lit(5)) == batch)
        stored.splice(part, batch, "o_orderstatus = 'F' AND o_orderkey % 5 = 0")
    return stored.read()


@query(_DAILY_HISTORY)
def scd2_history_by_day(spark, sf_dir):
    """Three pulls by a date into a stored history; a pull reads the days from its first change on."""
    days = _orders(spark, sf_dir).select(F.col("o_orderpriority").alias("key"), F.to_date("o_orderdate").alias("day"), (F.col("o_orderkey") % 7).alias("grade"))
    top = days.groupBy("key", "day").agg(F.max("grade").alias("grade"))
    target = RelationalTarget(spark, scratch_path(spark, "pulls"), TableSpec("days", ("key",), cursor="day", scd_type=2), buckets=2)
    for run, last in enumerate(("1996-01-01", "1999-01-01", "2100-01-01")):
        target.run_pull(top.filter(F.col("day") < F.lit(last).cast("date")), run)
    return target.read().select("key", "grade", "valid_from", "valid_to")


@query(
    """
SELECT key, o_orderkey, o_totalprice, o_orderstatus FROM (
  SELECT o_custkey AS key, *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1 AND NOT (o_orderstatus = 'F' AND o_orderkey % 5 = 0)
"""
)
def scd2_open_equals_scd1(spark, sf_dir):
    return open_versions(scd2_history(spark, sf_dir))


@query("SELECT * FROM orders WHERE o_orderstatus <> 'F'")
def append_only_changes(spark, sf_dir):
    return append_only(_orders(spark, sf_dir), "o_orderstatus = 'F'")


@query("SELECT event_id, user_id, value, CAST(ts AS DATE) AS day FROM events WHERE event_id % 4 <> 3")
def append_only_ingest(spark, sf_dir):
    """Two runs into an append-only target without primary keys; many rows share a cursor value."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value", F.to_date("ts").alias("day"))
    middle = F.lit("2024-01-15").cast("date")
    spec = TableSpec("events", (), cursor="day", scd_type="append", delete_when="event_id % 4 = 3")
    base = scratch_path(spark, "append")
    for run, seen in enumerate((events.filter(F.col("day") <= middle), events)):
        target = ingest_tables(spark, base, [spec], lambda name, rows=seen: rows, run)["events"]
    return target.read().drop("_pulled_at")


@query("SELECT event_id, ts, user_id, value FROM events")
def cursor_stream(spark, sf_dir):
    """Three triggers over a table that grows; each goes on at the cursor that Spark's checkpoint holds."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    base = scratch_path(spark, "cursor-stream")
    for first, last in ((1, 10), (11, 20), (21, 31)):
        events.filter(F.dayofmonth("ts").between(first, last)).write.mode("append").parquet(f"{base}/source")
        rows = stream_by_cursor(spark, f"{base}/source", "ts")
        trigger = rows.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True)
        trigger.start(f"{base}/appended").awaitTermination()
    return spark.read.schema(events.schema).parquet(f"{base}/appended")


@query("SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber > 1)")
def hard_delete_after_pull(spark, sf_dir):
    """A cursor pull followed by one with a snapshot of the keys that are left."""
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderdate")
    left = table(spark, sf_dir, "lineitem").filter("l_linenumber > 1").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    target = RelationalTarget(spark, scratch_path(spark, "keys"), TableSpec("orders", ("o_orderkey",), cursor="o_orderdate"))
    target.run_pull(orders, 0)
    target.run_pull(orders, 1, key_snapshot=left)
    return target.read()


@query(_latest("o_orderstatus <> 'F'"))
def soft_delete(spark, sf_dir):
    return current_state(_orders(spark, sf_dir), ["o_custkey"], NEWEST, "o_orderstatus = 'F'")


@query("SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def hard_delete_detected(spark, sf_dir):
    keys = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return hard_deleted(_orders(spark, sf_dir), keys, ["o_orderkey"])


@query("SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber > 1)")
def hard_delete_by_bitmap(spark, sf_dir):
    """Only keys whose bitmaps differ are joined."""
    keys = table(spark, sf_dir, "lineitem").filter("l_linenumber > 1").select(F.col("l_orderkey").alias("o_orderkey"))
    return bitmap_deleted(_orders(spark, sf_dir), keys, ["o_orderkey"])


@query("SELECT * FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)")
def hard_delete_applied(spark, sf_dir):
    keys = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return apply_hard_deletes(_orders(spark, sf_dir), keys, ["o_orderkey"])


_FEED = """
WITH feed AS (
  SELECT c_custkey AS key, c_acctbal AS amount, CAST(NULL AS BIGINT) AS seq, 's' AS op FROM customer
  UNION ALL
  SELECT o_custkey, o_totalprice, o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'd' ELSE 'u' END FROM orders)
SELECT key, amount, seq, op FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY seq DESC NULLS LAST) AS rn FROM feed)
WHERE rn = 1 AND op <> 'd'
"""


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshot = table(spark, sf_dir, "customer").selectExpr("c_custkey AS key", "c_acctbal AS amount")
    events = _orders(spark, sf_dir).selectExpr(
        "o_custkey AS key", "o_totalprice AS amount", "o_orderkey AS seq",
        "CASE WHEN o_orderkey % 10 = 0 THEN 'd' ELSE 'u' END AS op",
    )
    return change_feed(snapshot, events, "seq")


@query(_FEED)
def change_feed_apply(spark, sf_dir):
    return current_state(_feed(spark, sf_dir), ["key"], ["seq"], "op = 'd'")


@query(_FEED)
def change_feed_incremental(spark, sf_dir):
    """Three triggers over a feed that grows; each applies what lies past the position stored by the one before."""
    feed = _feed(spark, sf_dir)
    spec = TableSpec("feed", ("key",), cursor="seq", delete_when="op = 'd'")
    target = RelationalTarget(spark, scratch_path(spark, "feed"), spec, buckets=8)
    last = feed.agg(F.max("seq")).first()[0]
    for trigger in range(3):
        captured = F.col("seq").isNull() | (F.col("seq") * 3 <= last * (trigger + 1))
        target.run_pull(feed.filter(captured), trigger)
    return target.read().select("key", "amount", "seq", "op")


@query(
    """
WITH changes AS (
  SELECT o_custkey AS key, o_totalprice AS amount, o_orderkey AS seq,
    CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN 0 WHEN o_orderdate < TIMESTAMP '1999-06-01' THEN 1 ELSE 2 END AS pull
  FROM orders
), seen AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY key, pull ORDER BY seq DESC) AS rn FROM changes) WHERE rn = 1)
SELECT key, amount, seq AS valid_from, lead(seq) OVER (PARTITION BY key ORDER BY seq) AS valid_to FROM seen
"""
)
def pull_mode_history(spark, sf_dir):
    """What three scheduled pulls see: the last change of each key before each pull."""
    changes = _orders(spark, sf_dir).selectExpr(
        "o_custkey AS key", "o_totalprice AS amount", "o_orderkey AS seq",
        """CASE WHEN o_orderdate < TIMESTAMP_NTZ '1997-01-01 00:00:00' THEN 0
             WHEN o_orderdate < TIMESTAMP_NTZ '1999-06-01 00:00:00' THEN 1 ELSE 2 END AS pull""",
    )
    seen = current_state(changes, ["key", "pull"], ["seq"])
    return history(seen.drop("pull"), ["key"], "seq").drop("seq")


_MODIFIED = (
    "o_orderkey", "o_custkey", "o_orderstatus",
    "CASE WHEN o_orderkey % 50 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice",
    "CASE WHEN o_orderkey % 100 = 0 THEN o_orderdate + INTERVAL '1' DAY ELSE o_orderdate END AS o_orderdate",
    "o_orderpriority",
)


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderkey % 50 = 0 AND o_orderkey % 100 <> 0")
def cursor_audit(spark, sf_dir):
    before = _orders(spark, sf_dir)
    return audit_cursor(before, before.selectExpr(*_MODIFIED), ["o_orderkey"], "o_orderdate")


@query(
    """
SELECT o_orderkey, 'update' AS change FROM orders WHERE o_orderkey % 50 = 0 AND o_orderkey % 75 <> 0 AND o_orderkey % 90 <> 0
UNION ALL SELECT o_orderkey, 'delete' FROM orders WHERE o_orderkey % 75 = 0 AND o_orderkey % 90 <> 0
UNION ALL SELECT o_orderkey, 'insert' FROM orders WHERE o_orderkey % 90 = 0 AND o_orderkey % 75 <> 0
"""
)
def reconciled_by_ranges(spark, sf_dir):
    """Checksums per range of keys find the rows that were changed, lost or added."""
    orders = _orders(spark, sf_dir)
    after = orders.selectExpr(*_MODIFIED).filter("o_orderkey % 75 <> 0")
    return reconcile(orders.filter("o_orderkey % 90 <> 0"), after, ["o_orderkey"], leaf_rows=8).withColumnRenamed("_change", "change")


@query("SELECT o_orderkey, 'delete' AS change FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def reconciled_keys(spark, sf_dir):
    """Keys alone are compared: rows that are gone from the source."""
    keys = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    found = reconcile(_orders(spark, sf_dir).select("o_orderkey"), keys, ["o_orderkey"])
    return found.filter("_change = 'delete'").withColumnRenamed("_change", "change")


@query(
    """
WITH before AS (SELECT * FROM orders WHERE o_orderkey % 7 <> 0),
after AS (SELECT * REPLACE (CASE WHEN o_orderkey % 13 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice)
  FROM orders WHERE o_orderkey % 11 <> 0)
SELECT o_orderkey,
  CASE WHEN b.o_custkey IS NULL THEN 'insert' WHEN a.o_custkey IS NULL THEN 'delete' ELSE 'update' END AS change,
  b.o_totalprice AS old_price, a.o_totalprice AS new_price
FROM before b FULL OUTER JOIN after a USING (o_orderkey)
WHERE b.o_custkey IS NULL OR a.o_custkey IS NULL OR a.o_totalprice <> b.o_totalprice
"""
)
def table_changes_between(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    before = orders.filter("o_orderkey % 7 <> 0")
    after = orders.filter("o_orderkey % 11 <> 0").withColumn(
        "o_totalprice", F.expr("CASE WHEN o_orderkey % 13 = 0 THEN o_totalprice * 2 ELSE o_totalprice END")
    )
    return _change_columns(table_changes(before, after, ["o_orderkey"]), "o_orderkey")


def _change_columns(changes: DataFrame, key: str) -> DataFrame:
    return changes.select(
        key, F.col("_change").alias("change"),
        F.col("_before.o_totalprice").alias("old_price"), F.col("_after.o_totalprice").alias("new_price"),
    )


def _upserted(spark: SparkSession, sf_dir: str) -> KeyedTable:
    """Orders in three batches whose sequences overlap, so that older rows come late."""
    state = KeyedTable(spark, scratch_path(spark, "state"), ["o_custkey"], NEWEST, buckets=8, max_deltas=1)
    for batch in range(3):
        rows = _orders(spark, sf_dir).filter(F.col("o_orderkey") % 3 == batch)
        state.upsert(rows, "orders", batch, "o_orderstatus = 'F'")
    return state


@query(_latest("o_orderstatus <> 'F'"))
def keyed_table_upserts(spark, sf_dir):
    return _upserted(spark, sf_dir).read()


@query(
    f"""
WITH first AS ({_latest("o_orderstatus <> 'F'", "(SELECT * FROM orders WHERE o_orderkey % 3 = 0)")}),
final AS ({_latest("o_orderstatus <> 'F'")})
SELECT o_custkey,
  CASE WHEN b.o_orderkey IS NULL THEN 'insert' WHEN a.o_orderkey IS NULL THEN 'delete' ELSE 'update' END AS change,
  b.o_totalprice AS old_price, a.o_totalprice AS new_price
FROM first b FULL OUTER JOIN final a USING (o_custkey)
WHERE b.o_orderkey IS NULL OR a.o_orderkey IS NULL OR a.o_orderkey <> b.o_orderkey
"""
)
def keyed_table_changes(spark, sf_dir):
    """The change feed of a keyed table between its first and its last version."""
    state = _upserted(spark, sf_dir)
    return _change_columns(state.changes(0), "o_custkey")


@query("SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 10 DAY")
def staged_changes_retained(spark, sf_dir):
    as_of = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return retained(table(spark, sf_dir, "events"), "ts", as_of, days=10)


@query(
    """
SELECT count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-21') AS expired_changes,
  count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-21') AS retained_changes, TRUE AS resnapshot_needed FROM events
"""
)
def resnapshot_check(spark, sf_dir):
    as_of = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    start = F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")
    return needs_resnapshot(table(spark, sf_dir, "events"), start, "ts", as_of, days=10)


@query(
    """
SELECT 'orders' AS source, o_orderkey AS key, o_totalprice + CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 0 END AS amount FROM orders
UNION ALL
SELECT 'customer', c_custkey, c_acctbal FROM customer WHERE c_custkey % 4 <> 0
UNION ALL
SELECT 'supplier', s_suppkey, s_acctbal FROM supplier
"""
)
def multi_table_ingest(spark, sf_dir):
    """Two runs over three tables: one by cursor, one fully reloaded with rows gone, one unchanged."""
    base = scratch_path(spark, "relational")
    specs = [
        TableSpec("orders", ("o_orderkey",), "modified"),
        TableSpec("customer", ("c_custkey",)),
        TableSpec("supplier", ("s_suppkey",)),
    ]
    orders = _orders(spark, sf_dir)
    customers, suppliers = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    touched = "CASE WHEN o_orderkey % 10 = 0 THEN {} ELSE {} END AS {}"
    first = {
        "orders": orders.withColumn("modified", F.col("o_orderdate")),
        "customer": customers,
        "supplier": suppliers,
    }
    second = {
        "orders": orders.selectExpr(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority",
            touched.format("o_totalprice + 1", "o_totalprice", "o_totalprice"),
            touched.format("o_orderdate + INTERVAL '10' YEAR", "o_orderdate", "modified"),
        ),
        "customer": customers.filter("c_custkey % 4 <> 0"),
        "supplier": suppliers,
    }
    for run, sources in enumerate((first, second)):
        targets = ingest_tables(spark, base, specs, sources.__getitem__, run, buckets=8)
    parts = [("orders", "o_orderkey", "o_totalprice"), ("customer", "c_custkey", "c_acctbal"),
             ("supplier", "s_suppkey", "s_acctbal")]
    rows = None
    for name, key, amount in parts:
        part = targets[name].read().select(
            F.lit(name).alias("source"), F.col(key).alias("key"), F.col(amount).alias("amount")
        )
        rows = part if rows is None else rows.unionByName(part)
    return rows
