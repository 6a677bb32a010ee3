import random

import pytest
from pyspark.sql import functions as F

from sluiceway.operators.changes import current_state, table_changes
from sluiceway.streaming.keyed_table import KeyedTable

SCHEMA = "key int, seq int, value string, op string"


def make_rows(seed, count=120, keys=25):
    chosen = random.Random(seed)
    pairs = {(chosen.randrange(keys), chosen.randrange(200)) for _ in range(count)}
    return [(k, s, f"v{k}-{s}", chosen.choice("uuud")) for k, s in sorted(pairs)]


def expected(spark, rows):
    return sorted(map(tuple, current_state(spark.createDataFrame(rows, SCHEMA), ["key"], ["seq"], "op = 'd'").collect()))


def contents(table, version=None):
    return sorted(map(tuple, table.read(version).collect()))


def table_at(spark, path, **kind):
    kind.setdefault("buckets", 4)
    return KeyedTable(spark, str(path), ["key"], ["seq"], **kind)


@pytest.mark.parametrize("kind", [{"max_deltas": 0}, {"max_deltas": 1}, {"max_deltas": 8}, {"buckets": 3}])
def test_batches_in_any_split_and_order_give_the_same_state(spark, tmp_path, kind):
    rows = make_rows(1)
    shuffled = rows[:]
    random.Random(2).shuffle(shuffled)
    table = table_at(spark, tmp_path / "t", **kind)
    for batch in range(4):
        table.upsert(spark.createDataFrame(shuffled[batch::4], SCHEMA), "q", batch, "op = 'd'")
    assert contents(table) == expected(spark, rows)
    table.compact()
    assert all(len(commits) == 1 for commits in table.commit(table.version())["live"].values())
    assert contents(table) == expected(spark, rows)


def test_without_broadcast_the_state_is_the_same(spark, tmp_path):
    rows = make_rows(3)
    table = table_at(spark, tmp_path / "t")
    for batch in range(3):
        table.upsert(spark.createDataFrame(rows[batch::3], SCHEMA), "q", batch, "op = 'd'")
    with_broadcast = contents(table)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert contents(table) == with_broadcast == expected(spark, rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    table = table_at(spark, tmp_path / "t")
    first = table.upsert(spark.createDataFrame(make_rows(4), SCHEMA), "q", 0)
    assert table.upsert(spark.createDataFrame(make_rows(5), SCHEMA), "q", 0) == first
    assert table.version() == first and table.applied("q") == 0 and table.applied("other") == -1


def test_a_write_without_commit_is_invisible_and_repeated(spark, tmp_path):
    rows = make_rows(6)
    table = table_at(spark, tmp_path / "t")
    table.upsert(spark.createDataFrame(rows[:50], SCHEMA), "q", 0, "op = 'd'")
    seen = contents(table)

    def die():
        raise RuntimeError("lost the driver")

    with pytest.raises(RuntimeError):
        table.upsert(spark.createDataFrame(rows[50:], SCHEMA), "q", 1, "op = 'd'", before_commit=die)
    assert contents(table) == seen
    again = table_at(spark, tmp_path / "t")
    again.upsert(spark.createDataFrame(rows[50:], SCHEMA), "q", 1, "op = 'd'")
    assert contents(again) == expected(spark, rows)


def test_a_late_older_row_does_not_bring_a_deleted_key_back(spark, tmp_path):
    table = table_at(spark, tmp_path / "t")
    table.upsert(spark.createDataFrame([(1, 10, "x", "u"), (1, 20, "x", "d")], SCHEMA), "q", 0, "op = 'd'")
    table.upsert(spark.createDataFrame([(1, 15, "late", "u")], SCHEMA), "q", 1, "op = 'd'")
    assert contents(table) == []
    table.upsert(spark.createDataFrame([(1, 30, "new", "u")], SCHEMA), "q", 2, "op = 'd'")
    assert contents(table) == [(1, 30, "new", "u")]


@pytest.mark.parametrize("max_deltas", [0, 1, 8])
def test_changes_equal_the_difference_of_whole_states(spark, tmp_path, max_deltas):
    rows = make_rows(7, 200)
    random.Random(8).shuffle(rows)
    table = table_at(spark, tmp_path / "t", max_deltas=max_deltas)
    for batch in range(4):
        table.upsert(spark.createDataFrame(rows[batch::4], SCHEMA), "q", batch, "op = 'd'")
    last = table.version()
    for before in (0, 1, 2):
        found = sorted(map(str, table.changes(before).collect()))
        whole = table_changes(table.read(before), table.read(last), ["key"])
        assert found == sorted(map(str, whole.collect()))
    assert table.changes(None).filter("_change <> 'insert'").count() == 0
    assert table.changes(None).count() == table.read().count()


def test_columns_are_added_and_never_retyped(spark, tmp_path):
    table = table_at(spark, tmp_path / "t")
    table.upsert(spark.createDataFrame([(1, 1, "a", "u"), (2, 1, "b", "u")], SCHEMA), "q", 0)
    wider = spark.createDataFrame([(2, 2, "c", "u", 5)], SCHEMA + ", more int")
    table.upsert(wider, "q", 1)
    assert contents(table) == [(1, 1, "a", "u", None), (2, 2, "c", "u", 5)]
    with pytest.raises(TypeError, match="more"):
        table.upsert(wider.withColumn("more", F.lit("text")), "q", 2)


def test_expire_keeps_what_versions_need(spark, tmp_path):
    rows = make_rows(9)
    table = table_at(spark, tmp_path / "t", max_deltas=1)
    for batch in range(5):
        table.upsert(spark.createDataFrame(rows[batch::5], SCHEMA), "q", batch, "op = 'd'")
    whole, changes = contents(table), table.changes(table.version() - 1).count()
    assert table.expire(keep=2)
    assert contents(table) == whole == expected(spark, rows)
    assert table.changes(table.version() - 1).count() == changes


def test_other_keys_are_refused(spark, tmp_path):
    table_at(spark, tmp_path / "t").upsert(spark.createDataFrame(make_rows(1), SCHEMA), "q", 0)
    with pytest.raises(ValueError):
        KeyedTable(spark, str(tmp_path / "t"), ["value"], ["seq"], buckets=4)
    assert KeyedTable(spark, str(tmp_path / "t"), ["key"], ["seq"]).buckets == 4


def test_an_empty_batch_is_remembered(spark, tmp_path):
    table = table_at(spark, tmp_path / "t")
    table.upsert(spark.createDataFrame([], SCHEMA), "q", 0, meta={"watermark": 3})
    assert table.applied("q") == 0 and table.read().count() == 0 and table.meta() == {"watermark": 3}
    assert table.changes(None).count() == 0


def test_a_dead_attempt_beside_a_live_one_leaves_the_table_readable(spark, tmp_path):
    rows = make_rows(6)
    table = table_at(spark, tmp_path / "t")
    table.upsert(spark.createDataFrame(rows[:50], SCHEMA), "q", 0, "op = 'd'")

    def overtaken():
        table_at(spark, tmp_path / "t").upsert(spark.createDataFrame(rows[50:], SCHEMA), "q", 1, "op = 'd'")

    with pytest.raises(FileExistsError):
        table.upsert(spark.createDataFrame(rows[50:60], SCHEMA), "q", 1, "op = 'd'", before_commit=overtaken)
    assert contents(table_at(spark, tmp_path / "t")) == expected(spark, rows)
