import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluiceway.operators.changes import (
    append_only,
    apply_hard_deletes,
    current_state,
    hard_deleted,
    history,
    latest_per_key,
    missing_keys,
    open_versions,
    table_changes,
)

SCHEMA = "key string, seq int, value int, op string"
change = st.tuples(
    st.sampled_from(["a", "b", "c"]), st.integers(1, 12), st.integers(0, 3), st.sampled_from(["u", "u", "d"])
)
# One row per (key, seq): ties are covered on their own.
changes = st.lists(change, max_size=25, unique_by=lambda r: (r[0], r[1]))
several = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def brute_state(rows):
    newest = {}
    for row in rows:
        if row[0] not in newest or row[1] > newest[row[0]][1]:
            newest[row[0]] = row
    return sorted(r for r in newest.values() if r[3] != "d")


def brute_history(rows):
    out = []
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: r[1])
        for row, following in zip(mine, [*mine[1:], None]):
            if row[3] != "d":
                out.append((*row, row[1], following[1] if following else None))
    return sorted(out, key=str)


@several
@given(changes, st.randoms())
def test_current_state_matches_brute_force_in_any_order(spark, rows, random):
    shuffled = list(rows)
    random.shuffle(shuffled)
    df = spark.createDataFrame(shuffled, SCHEMA)
    assert sorted(map(tuple, current_state(df, ["key"], ["seq"], "op = 'd'").collect())) == brute_state(rows)


@several
@given(changes)
def test_current_state_is_idempotent(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    once = latest_per_key(df, ["key"], ["seq"])
    twice = latest_per_key(once.unionByName(df), ["key"], ["seq"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


@several
@given(changes, st.sampled_from([1, 2, 3, 1000]))
def test_history_matches_brute_force_for_any_pieces(spark, rows, piece_rows):
    df = spark.createDataFrame(rows, SCHEMA)
    found = history(df, ["key"], "seq", "op = 'd'", piece_rows=piece_rows)
    assert sorted(map(tuple, found.collect()), key=str) == brute_history(rows)
    still_open = sorted(tuple(r)[:4] for r in open_versions(found).collect())
    assert still_open == brute_state(rows)


def test_one_hot_key_is_cut_at_its_sequences(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") < 2900, "hot").otherwise(F.col("id").cast("string")).alias("key"),
        F.col("id").alias("seq"), F.lit("u").alias("op"),
    )
    found = history(df, ["key"], "seq", piece_rows=50)
    hot = {r["valid_from"]: r["valid_to"] for r in found.filter("key = 'hot'").collect()}
    assert hot == {i: i + 1 if i < 2899 else None for i in range(2900)}
    assert found.filter("key <> 'hot' AND valid_to IS NULL").count() == 100


def test_history_keeps_one_of_equal_sequences(spark):
    df = spark.createDataFrame([("a", 1, 1, "u"), ("a", 1, 2, "u"), ("a", 2, 3, "u")], SCHEMA)
    for piece_rows in (1, 1000):
        found = history(df, ["key"], "seq", piece_rows=piece_rows).collect()
        assert sorted((r["valid_from"], r["valid_to"]) for r in found) == [(1, 2), (2, None)]


def test_history_of_a_coarse_sequence(spark):
    df = spark.range(2000).select(
        F.lit("a").alias("key"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("seq"), F.col("id").alias("value")
    )
    for piece_rows in (1, 1000):
        found = history(df, ["key"], "seq", piece_rows=piece_rows).collect()
        assert sorted(((r["valid_from"], r["valid_to"]) for r in found), key=str) == [(1, 2), (2, None), (None, 1)]


def test_a_delete_among_equal_sequences_is_kept_or_not_as_a_whole(spark):
    df = spark.createDataFrame([("a", 1, 1, "u"), ("a", 2, 2, "u"), ("a", 2, 3, "d")], SCHEMA)
    found = sorted((r["valid_from"], r["valid_to"]) for r in history(df, ["key"], "seq", "op = 'd'").collect())
    assert found in ([(1, 2)], [(1, 2), (2, None)])


def test_history_takes_any_ordered_sequence(spark):
    df = spark.range(200).select(F.lit("a").alias("key"), F.format_string("%05d", "id").alias("seq"))
    found = history(df, ["key"], "seq", piece_rows=10)
    assert {(r["valid_from"], r["valid_to"]) for r in found.collect()} == {
        (f"{i:05d}", f"{i + 1:05d}" if i < 199 else None) for i in range(200)
    }


def test_null_sequence_is_oldest_and_null_key_is_left_out(spark):
    df = spark.createDataFrame(
        [("a", None, 1, "u"), ("b", None, 2, "u"), ("b", 1, 3, "u"), (None, 9, 4, "u")], SCHEMA
    )
    state = {r["key"]: r["value"] for r in current_state(df, ["key"], ["seq"]).collect()}
    assert state == {"a": 1, "b": 3}
    assert missing_keys(df, ["key"]).count() == 1
    versions = history(df, ["key"], "seq").filter("key = 'b'").collect()
    assert {(r["valid_from"], r["valid_to"]) for r in versions} == {(None, 1), (1, None)}


def test_ties_do_not_depend_on_order(spark):
    rows = [("a", 1, i, "u") for i in range(20)]
    winners = {
        latest_per_key(spark.createDataFrame(order, SCHEMA).repartition(n), ["key"], ["seq"]).first()["value"]
        for n, order in ((1, rows), (3, rows[::-1]), (5, rows[7:] + rows[:7]))
    }
    assert len(winners) == 1


def test_variant_rides_along(spark):
    df = spark.createDataFrame([("a", 1, '{"x":1}'), ("a", 2, '{"x":2}')], "key string, seq int, body string")
    df = df.select("key", "seq", F.try_parse_json("body").alias("v"))
    newest = latest_per_key(df, ["key"], ["seq"]).select(F.expr("v:x::int")).first()
    assert newest[0] == 2


def test_append_only_leaves_deletes_out(spark):
    df = spark.createDataFrame([("a", 1, 1, "u"), ("a", 1, 1, "u"), ("a", 2, 2, "d"), ("b", 1, 1, None)], SCHEMA)
    assert append_only(df, "op = 'd'").count() == 3
    assert append_only(df).count() == 4


def test_hard_deletes_are_the_set_difference(spark):
    state = spark.createDataFrame([(i,) for i in range(10)], "id int")
    snapshot = spark.createDataFrame([(i,) for i in range(3, 20)], "id int")
    assert sorted(r[0] for r in hard_deleted(state, snapshot, ["id"]).collect()) == [0, 1, 2]
    assert sorted(r[0] for r in apply_hard_deletes(state, snapshot, ["id"]).collect()) == list(range(3, 10))


@pytest.mark.parametrize("extra", [False, True])
def test_table_changes_tags_rows(spark, extra):
    before = spark.createDataFrame([("a", 1), ("b", None), ("c", 3)], "key string, value int")
    after = spark.createDataFrame([("b", None), ("c", 4), ("d", None)], "key string, value int")
    if extra:
        after = after.withColumn("added", F.when(F.col("key") == "b", 1))
    found = {r["key"]: r["_change"] for r in table_changes(before, after, ["key"]).collect()}
    expected = {"a": "delete", "c": "update", "d": "insert"}
    assert found == ({**expected, "b": "update"} if extra else expected)


def test_table_changes_can_ignore_stamps(spark):
    before = spark.createDataFrame([("a", 1, 1)], "key string, value int, stamp int")
    after = spark.createDataFrame([("a", 1, 2)], "key string, value int, stamp int")
    assert table_changes(before, after, ["key"], ignore=["stamp"]).count() == 0
    assert table_changes(before, after, ["key"]).count() == 1
