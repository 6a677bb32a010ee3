import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from sluiceway.operators.changes import current_state, history
from sluiceway.operators.reconcile import bitmap_deleted, differing_rows, reconcile
from sluiceway.plans.relational import RelationalTarget, ResnapshotNeeded, ingest_tables
from sluiceway.sources.cursor_stream import CursorReader, decode, encode, stream_by_cursor
from sluiceway.sources.relational import (
    JdbcSource,
    TableSpec,
    audit_cursor,
    change_feed,
    needs_resnapshot,
    next_watermark,
    pull,
    retained,
)
from sluiceway.streaming.history_table import StoredHistory

DDL = "OrderID int, Amount double, Status string, IsDeleted int, ModifiedDate timestamp"


def orders(spark, rows):
    return spark.createDataFrame([(*r[:4], datetime(2024, 1, r[4])) for r in rows], DDL)


FIRST = [(1, 10.0, "new", 0, 1), (2, 20.0, "new", 0, 2), (3, 30.0, "new", 0, 3)]
SECOND = [(1, 11.0, "paid", 0, 5), (2, 20.0, "new", 1, 6), (3, 30.0, "new", 0, 3), (4, 40.0, "new", 0, 4)]


def state(target):
    return {r["OrderID"]: r["Amount"] for r in target.read().collect()}


def test_pulls_follow_the_watermark_and_soft_deletes(spark, tmp_path):
    spec = TableSpec("Orders", ("OrderID",), "ModifiedDate", delete_when="IsDeleted = 1")
    target = RelationalTarget(spark, str(tmp_path), spec, buckets=2)
    target.run_pull(orders(spark, FIRST), 0)
    assert target.watermark()["text"].startswith("2024-01-03") and state(target) == {1: 10.0, 2: 20.0, 3: 30.0}
    target.run_pull(orders(spark, SECOND), 1)
    assert target.watermark()["text"].startswith("2024-01-06") and state(target) == {1: 11.0, 3: 30.0, 4: 40.0}
    assert target.staged(1).count() == 3
    version = target.table.version()
    target.run_pull(orders(spark, SECOND), 1)
    assert target.table.version() == version
    target.run_pull(orders(spark, SECOND), 2)
    assert target.watermark()["text"].startswith("2024-01-06") and state(target) == {1: 11.0, 3: 30.0, 4: 40.0}


def test_an_update_that_does_not_move_the_cursor_is_missed_and_audited(spark, tmp_path):
    moved = [(1, 99.0, "new", 0, 1), *FIRST[1:]]
    target = RelationalTarget(spark, str(tmp_path), TableSpec("Orders", ("OrderID",), "ModifiedDate"), buckets=2)
    target.run_pull(orders(spark, FIRST), 0)
    target.run_pull(orders(spark, moved), 1)
    assert state(target)[1] == 10.0
    flagged = audit_cursor(orders(spark, FIRST), orders(spark, moved), ["OrderID"], "ModifiedDate")
    assert [r["OrderID"] for r in flagged.collect()] == [1]


def test_without_a_cursor_each_run_replaces_the_state(spark, tmp_path):
    target = RelationalTarget(spark, str(tmp_path), TableSpec("Orders", ("OrderID",)), buckets=2)
    target.run_pull(orders(spark, FIRST), 0)
    target.run_pull(orders(spark, FIRST[1:]).withColumn("Amount", F.col("Amount") + 1), 1)
    assert state(target) == {2: 21.0, 3: 31.0}
    target.run_pull(orders(spark, FIRST), 2)
    assert state(target) == {1: 10.0, 2: 20.0, 3: 30.0}


def test_history_and_append_targets(spark, tmp_path):
    for kind, expected in ((2, 6), ("append", 6)):
        spec = TableSpec(f"t{kind}", ("OrderID",), "ModifiedDate", kind)
        target = RelationalTarget(spark, str(tmp_path), spec, buckets=2)
        target.run_pull(orders(spark, FIRST), 0)
        target.run_pull(orders(spark, SECOND), 1)
        assert target.read().count() == expected
    versions = RelationalTarget(
        spark, str(tmp_path), TableSpec("t2", ("OrderID",), "ModifiedDate", 2), buckets=2
    ).read().filter("OrderID = 1").orderBy("valid_from").collect()
    assert [(r["valid_from"].day, r["valid_to"] and r["valid_to"].day) for r in versions] == [(1, 5), (5, None)]


def test_several_tables_in_one_run(spark, tmp_path):
    specs = [TableSpec("a", ("OrderID",), "ModifiedDate"), TableSpec("b", ("OrderID",))]
    targets = ingest_tables(spark, str(tmp_path), specs, lambda name: orders(spark, FIRST), 0, buckets=2)
    assert {n: len(state(t)) for n, t in targets.items()} == {"a": 3, "b": 3}


def test_feed_sees_what_pulls_miss(spark):
    snapshot = spark.createDataFrame([(1, 5), (2, 6)], "k int, v int")
    events = spark.createDataFrame(
        [(1, 7, 10, "u"), (1, 8, 11, "u"), (2, None, 12, "d"), (3, 9, 13, "i"), (2, 1, 9, "u")],
        "k int, v int, seq bigint, op string",
    )
    feed = change_feed(snapshot, events, "seq")
    now = {r["k"]: r["v"] for r in current_state(feed, ["k"], ["seq"], "op = 'd'").collect()}
    assert now == {1: 8, 3: 9}
    full = {(r["k"], r["v"]) for r in history(feed, ["k"], "seq", "op = 'd'").collect()}
    assert full == {(1, 5), (1, 7), (1, 8), (2, 6), (2, 1), (3, 9)}
    pulled = current_state(events.filter("seq > 9"), ["k"], ["seq"])
    seen = {(r["k"], r["v"]) for r in history(pulled, ["k"], "seq", "op = 'd'").collect()}
    assert seen < full


def test_retention_and_resnapshot(spark):
    feed = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 2, 1))], "k int, at timestamp")
    as_of = F.lit(datetime(2024, 2, 15))
    assert [r["k"] for r in retained(feed, "at", as_of).collect()] == [2]
    check = needs_resnapshot(feed, F.lit(datetime(2024, 1, 10)), "at", as_of).first()
    assert (check["expired_changes"], check["retained_changes"], check["resnapshot_needed"]) == (1, 1, True)


def test_pull_filter_reaches_the_scan(spark, tmp_path):
    orders(spark, FIRST).write.parquet(str(tmp_path / "o"))
    pulled = pull(spark.read.parquet(str(tmp_path / "o")), "ModifiedDate", datetime(2024, 1, 2))
    plan = pulled._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ModifiedDate" in plan
    assert next_watermark(pulled, "ModifiedDate") == datetime(2024, 1, 3)
    assert next_watermark(pulled.filter("false"), "ModifiedDate", 5) == 5


def test_specs_are_checked():
    with pytest.raises(ValueError, match="primary key"):
        TableSpec("t", ("id",), "id")
    with pytest.raises(ValueError, match="cursor"):
        TableSpec("t", ("id",), None, 2)
    with pytest.raises(ValueError):
        TableSpec("t", ("id",), "m", 3)
    with pytest.raises(ValueError):
        TableSpec("t", (), "m")


def test_jdbc_options():
    source = JdbcSource("jdbc:x://h/db", {"user": "u"})
    assert source.reader_options("dbo.Orders") == {"url": "jdbc:x://h/db", "dbtable": "dbo.Orders", "user": "u"}
    split = source.reader_options("t", "id", 1, 100, 8)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", "1", "100", "8")


def test_append_only_keeps_equal_and_null_cursors(spark, tmp_path):
    rows = spark.createDataFrame([(1, 5), (2, 5), (3, 6), (4, None), (4, None)], "id int, c int")
    for name, keys, cursor in (("a", (), "c"), ("b", (), None), ("c", ("id",), "c")):
        target = RelationalTarget(spark, str(tmp_path), TableSpec(name, keys, cursor=cursor, scd_type="append"))
        target.run_pull(rows, 0)
        target.run_pull(rows, 0)
        assert target.read().count() == 5
        target.run_pull(rows.unionAll(spark.createDataFrame([(9, 7)], "id int, c int")), 1)
        assert target.read().count() == (6 if cursor else 11)


def test_watermarks_keep_their_type(spark, tmp_path):
    kinds = {
        "date": ("2024-01-01", "2024-01-02"), "decimal(12,4)": ("1.2500", "10.5000"), "timestamp": ("2024-01-01 00:00:00.000001", "2024-03-31 02:30:00"),
        "timestamp_ntz": ("2024-01-01 00:00:00", "2024-01-02 00:00:00"), "bigint": ("9", "10"), "string": ("a", "b"), "double": ("0.1", "0.30000000000000004"),
    }
    for i, (kind, (old, new)) in enumerate(kinds.items()):
        rows = spark.createDataFrame([(1, old), (2, new)], "id int, c string").withColumn("c", F.col("c").cast(kind))
        target = RelationalTarget(spark, f"{tmp_path}/{i}", TableSpec("t", ("id",), cursor="c"))
        target.run_pull(rows.filter("id = 1"), 0)
        assert target.watermark()["type"] == kind
        target.run_pull(rows.withColumn("id", F.col("id") + 10), 1)
        assert sorted(r.id for r in target.read().collect()) == [1, 12]
    binary = spark.createDataFrame([(1, bytearray(b"\x00\xff")), (2, bytearray(b"\x01\x00"))], "id int, c binary")
    target = RelationalTarget(spark, f"{tmp_path}/binary", TableSpec("t", ("id",), cursor="c"))
    target.run_pull(binary.filter("id = 1"), 0)
    target.run_pull(binary, 1)
    assert target.read().count() == 2 and target.watermark()["text"] == "0100"


def test_a_key_snapshot_deletes_what_is_gone(spark, tmp_path):
    schema = "id int, c int"
    target = RelationalTarget(spark, str(tmp_path), TableSpec("t", ("id",), cursor="c"))
    target.run_pull(spark.createDataFrame([(1, 1), (2, 2), (3, 3), (None, 4)], schema), 0)
    assert target.left_out(0) == 1
    target.run_pull(spark.createDataFrame([(1, 1), (4, 9)], schema), 1, key_snapshot=spark.createDataFrame([(1,), (4,)], "id int"))
    assert sorted(r.id for r in target.read().collect()) == [1, 4]
    target.run_pull(spark.createDataFrame([(2, 10)], schema), 2)
    assert sorted(r.id for r in target.read().collect()) == [1, 2, 4]


def test_a_staged_run_that_was_not_appended_is_not_lost(spark, tmp_path):
    target = RelationalTarget(spark, str(tmp_path), TableSpec("t", (), cursor="day", scd_type="append", delete_when="id % 10 = 9"))
    rows = spark.range(30).selectExpr("id", "id div 10 AS day")
    target.run_pull(rows.filter("day = 0"), 0)
    keep, target._keep = target._keep, lambda run: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        target.run_pull(rows.filter("day < 2"), 1)
    target._keep = keep
    target.run_pull(rows, 2)  # the schedule went on
    assert sorted(r.id for r in target.read().collect()) == [i for i in range(30) if i % 10 != 9]
    assert target.watermark()["text"] == "2"


def test_staged_runs_expire_in_the_job(spark, tmp_path):
    target = RelationalTarget(spark, str(tmp_path), TableSpec("t", ("id",), cursor="c", retention_days=30), buckets=2)
    for run, day in enumerate((date(2024, 1, 1), date(2024, 1, 20), date(2024, 2, 10))):
        target.run_pull(spark.range(run + 1).selectExpr("id", f"{run} AS c"), run, day=day)
    assert sorted(target._finished()) == [1, 2]
    assert target.staged_since(date(2024, 1, 15), date(2024, 2, 10)).count() == 5
    with pytest.raises(ResnapshotNeeded, match="2024-01-11"):
        target.staged_since(date(2024, 1, 10), date(2024, 2, 10))
    assert target.watermark()["text"] == "2" and target.read().count() == 3


def versions(df):
    return sorted(map(tuple, df.select("k", "v", "valid_from", "valid_to").collect()), key=str)


@pytest.mark.parametrize("kind", ["int", "date", "string"])
def test_a_spliced_history_equals_one_in_one_go(spark, tmp_path, kind):
    draw = random.Random(2)
    rows = [(draw.randrange(8), draw.randrange(400), draw.randrange(5)) for _ in range(500)] + [(None, 1, 1), (1, None, 1)]
    at = {"int": "s", "date": "date_add(date'2024-01-01', s)", "string": "lpad(s, 4, '0')"}[kind]
    changes = spark.createDataFrame(rows, "k int, s int, v int").selectExpr("k", f"{at} AS s", "v")
    stored = StoredHistory(spark, str(tmp_path / "h"), ["k"], "s", buckets=2, days=50, period=50)
    parts = changes.withColumn("part", F.pmod(F.xxhash64("k", "s", "v"), F.lit(5)))
    for number in range(5):
        for _ in range(2):  # a batch that comes again changes nothing
            stored.splice(parts.filter(F.col("part") == number).drop("part"), number, "v = 0", {"at": number})
    whole = history(changes.filter("s IS NOT NULL"), ["k"], "s", "v = 0")
    assert versions(stored.read()) == versions(whole)
    assert (stored.applied(), stored.meta()) == (4, {"at": 4})
    assert not stored._folder.names("pending")


def test_a_batch_reads_and_writes_only_what_it_can_touch(spark, tmp_path):
    path = tmp_path / "h"
    stored = StoredHistory(spark, str(path), ["k"], "s", buckets=1, period=100)
    with pytest.raises(ValueError):
        stored.read()
    stored.splice(spark.range(1000).selectExpr("id % 5 AS k", "id AS s", "id AS v"), 0)
    before = {f: f.stat().st_mtime_ns for f in path.glob("versions/*/*/*.parquet")}
    late = spark.createDataFrame([(2, 750, -1), (2, 1200, -2)], "k bigint, s bigint, v bigint")
    reach = stored.reach(late)
    assert {r["_ended"] for r in reach.select("_ended").distinct().collect()} == {7, 8, 9, None}
    filters = next(line for line in reach._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in line)
    assert "_ended" in filters.split("PartitionFilters:")[1].split("PushedFilters")[0]
    stored.splice(late, 1)
    after = {f: f.stat().st_mtime_ns for f in path.glob("versions/*/*/*.parquet")}
    changed = {f.parent.name for f in set(before) ^ set(after)}
    assert changed == {"_ended=7", "_ended=12", "_ended=__HIVE_DEFAULT_PARTITION__"}
    assert versions(stored.read().filter("k = 2 AND (v < 0 OR s BETWEEN 745 AND 755 OR s > 990)")) == sorted(
        [(2, 747, 747, 750), (2, -1, 750, 752), (2, 752, 752, 757), (2, 992, 992, 997), (2, 997, 997, 1200), (2, -2, 1200, None)], key=str
    )


def test_files_of_a_history_follow_its_partitions_and_not_the_tasks(spark, tmp_path):
    path, merge = tmp_path / "h", "spark.sql.adaptive.coalescePartitions.enabled"
    stored = StoredHistory(spark, str(path), ["k"], "s", buckets=2, period=50)
    before = spark.conf.get(merge)
    spark.conf.set(merge, "false")
    try:
        for number in range(2):
            changes = spark.range(number, 1000, 2).selectExpr("id % 20 AS k", "id AS s", "id AS v")
            stored.splice(changes, number)
            assert all(len(list(place.glob("*.parquet"))) == 1 for place in path.glob("versions/*/*"))
    finally:
        spark.conf.set(merge, before)
    whole = history(spark.range(1000).selectExpr("id % 20 AS k", "id AS s", "id AS v"), ["k"], "s")
    assert versions(stored.read()) == versions(whole)


def test_a_history_moves_into_place_again_after_a_lost_job(spark, tmp_path):
    stored = StoredHistory(spark, str(tmp_path / "h"), ["k"], "s", buckets=2)
    stored.splice(spark.range(20).selectExpr("id % 4 AS k", "id AS s", "id AS v"), 0)
    publish, stored._folder.publish = stored._folder.publish, lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
    more = spark.range(20, 30).selectExpr("id % 4 AS k", "id AS s", "id AS v")
    with pytest.raises(RuntimeError):
        stored.splice(more, 1)
    stored._folder.publish = publish
    stored.splice(more, 1)
    assert versions(stored.read()) == versions(history(spark.range(30).selectExpr("id % 4 AS k", "id AS s", "id AS v"), ["k"], "s"))


def test_new_columns_and_empty_batches_of_a_history(spark, tmp_path):
    stored = StoredHistory(spark, str(tmp_path / "h"), ["k"], "s", buckets=2)
    stored.splice(spark.createDataFrame([(1, 1)], "k int, s int"), 0)
    stored.splice(spark.createDataFrame([], "k int, s int"), 1)
    stored.splice(spark.createDataFrame([(1, 2, "x")], "k int, s int, extra string"), 2)
    found = sorted(map(tuple, stored.read().select("k", "extra", "valid_from", "valid_to").collect()), key=str)
    assert found == [(1, "x", 2, None), (1, None, 1, 2)]


def test_a_stream_by_cursor_keeps_its_place(spark, tmp_path):
    rows = spark.range(90).selectExpr("id", "IF(id = 5, NULL, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, id div 3)) AS at")
    source, out = str(tmp_path / "source"), str(tmp_path / "out")

    def trigger():
        stream = stream_by_cursor(spark, source, "at").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "mark"))
        stream.trigger(availableNow=True).start(out).awaitTermination()
        return sorted(r.id for r in spark.read.schema("id bigint").parquet(out).collect())

    for last in (30, 60, 90):
        rows.filter(f"id >= {last - 30} AND id < {last}").coalesce(1).write.mode("append").parquet(source)
        assert trigger() == list(range(last))
    assert trigger() == list(range(90))
    # A row without a cursor, or with one that was passed, comes too late, as with a pull.
    rows.filter("id IN (3, 5)").coalesce(1).write.mode("append").parquet(source)
    assert trigger() == list(range(90))


def test_only_row_groups_between_two_offsets_are_opened(tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    for name, numbers in (("a", [1, 2, None, 4, 5, 6]), ("b", [None, None]), ("_c", [99])):
        pq.write_table(pa.table({"n": pa.array(numbers, pa.int64())}), tmp_path / f"{name}.parquet", row_group_size=2)
    reader = CursorReader(str(tmp_path), "n")
    start, end = reader.initialOffset(), reader.latestOffset()
    assert end == {"kind": "int", "text": "6"}
    first = reader.partitions(start, end)
    assert [p.value[1] for p in first] == [[0, 1, 2], [0]]
    assert sorted(str(v) for p in first for b in reader.read(p) for v in b.column("n").to_pylist()) == ["1", "2", "4", "5", "6", "None", "None", "None"]
    part = reader.partitions({"kind": "int", "text": "4"}, end)
    assert [p.value[1] for p in part] == [[2]]
    assert [v for b in reader.read(part[0]) for v in b.column("n").to_pylist()] == [5, 6]
    assert reader.partitions(end, end) == []
    assert CursorReader(str(tmp_path / "none"), "n").latestOffset()["kind"] == "none"
    for value in (7, 1.5, "x", b"\x00\xff", date(2024, 1, 2), datetime(2024, 1, 2, 3, 4, 5, 6), None):
        assert decode(encode(value)) == value


@pytest.mark.parametrize("keys", [["id"], ["name"], ["id", "name"]])
def test_reconciliation_moves_what_differs(spark, keys):
    left = spark.range(20_000).selectExpr("id * 7 AS id", "concat('n', id) AS name", "id % 13 AS v", "id AS noise")
    right = left.selectExpr("id", "name", "IF(id % 14000 = 7, v + 1, v) AS v", "noise + 1 AS noise").filter("id % 21000 <> 14").unionAll(
        spark.createDataFrame([(-5, "new", 1, 1), (10**15, "far", 1, 1)], "id bigint, name string, v bigint, noise bigint")
    )
    changes = {(r["id"] if "id" in keys else r["name"]): r["_change"] for r in reconcile(left, right, keys, ["noise"], fanout=16, leaf_rows=16).collect()}
    want = {}
    for i in range(20_000):
        name = i * 7 if "id" in keys else f"n{i}"
        if i * 7 % 21000 == 14:
            want[name] = "delete"
        elif i * 7 % 14000 == 7:
            want[name] = "update"
    want |= {-5: "insert", 10**15: "insert"} if "id" in keys else {"new": "insert", "far": "insert"}
    assert changes == want
    moved = sum(df.count() for df in differing_rows(left, right, keys, ["v"], fanout=16, leaf_rows=16))
    assert moved < 3_000
    assert reconcile(left, left, keys).count() == 0
    assert reconcile(left.limit(0), left.limit(0), keys).count() == 0
    assert reconcile(left.limit(0), left, keys).count() == 20_000


def test_bitmaps_of_keys(spark):
    state = spark.createDataFrame([(k,) for k in (-40_000, -1, 0, 1, 32_768, 32_769, 10**12, None)], "k bigint")
    there = spark.createDataFrame([(k,) for k in (-1, 1, 1, 32_768, 32_769, None)], "k bigint")
    assert sorted(str(r.k) for r in bitmap_deleted(state, there, ["k"]).collect()) == sorted(map(str, (-40_000, 0, 10**12, None)))
    text = state.selectExpr("cast(k AS string) AS k")
    assert bitmap_deleted(text, there.selectExpr("cast(k AS string) AS k"), ["k"]).count() == 4
