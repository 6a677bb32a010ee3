import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from sluiceway.config import FileFeed
from sluiceway.plans import gold
from sluiceway.sources.discovery import SeenFiles, list_files
from sluiceway.sources.synthetic import seed_demo
from sluiceway.streaming import files as stream
from sluiceway.streaming.events import read_events
from sluiceway.streaming.files import FileTables


def feed_at(tmp_path, **kind):
    kind.setdefault("buckets", 4)
    source = tmp_path / "drops"
    source.mkdir(exist_ok=True)
    return FileFeed(str(source), str(tmp_path / "tables"), **kind)


def drop(df, feed, name):
    df.coalesce(1).write.parquet(f"{feed.source}/{name}")


def text_drop(feed, name, text):
    with open(os.path.join(feed.source, name), "w", encoding="utf-8") as out:
        out.write(text)


def test_demo_counts_and_second_seed(spark, tmp_path):
    feed = feed_at(tmp_path, dedup_keys="order_id")
    assert seed_demo(spark, feed.source) == 100
    tables = stream.update(spark, feed)
    bronze = tables.bronze()
    assert (bronze.count(), bronze.select("source_file").distinct().count()) == (100, 2)
    assert tables.silver().count() == 100
    health = gold.files_health(bronze, corrected=True).first()
    assert (health["files_ingested"], health["rows_ingested"]) == (2, 100)
    sizes = dict(bronze.select("source_file", "source_file_size").distinct().collect())
    assert health["distinct_file_bytes"] == sum(sizes.values())
    assert gold.rows_per_day(tables.silver()).first()["record_count"] == 100
    row = bronze.filter("order_id = 6").first()
    assert (row["region"], row["amount"]) == ("east", 63.0)
    # A second seed writes new files with the same ids.
    seed_demo(spark, feed.source)
    tables = stream.update(spark, feed)
    assert (tables.bronze().count(), tables.silver().count()) == (200, 100)


def test_nothing_new_means_nothing_done(spark, tmp_path):
    feed = feed_at(tmp_path)
    stream.update(spark, feed)
    assert FileTables(spark, feed).bronze().count() == 0
    drop(spark.range(5), feed, "one")
    assert stream.update(spark, feed).silver().count() == 5
    assert stream.update(spark, feed).silver().count() == 5


def test_small_batches_take_every_file_once(spark, tmp_path):
    feed = feed_at(tmp_path, max_files=2)
    for i in range(5):
        drop(spark.range(i * 10, i * 10 + 10), feed, f"d{i}/deep")
    assert sorted(r["id"] for r in stream.update(spark, feed).bronze().collect()) == list(range(50))


def test_a_changed_type_is_rescued_and_the_stream_lives(spark, tmp_path):
    feed = feed_at(tmp_path)
    drop(spark.sql("SELECT 1L AS id, 10 AS n"), feed, "a")
    stream.update(spark, feed)
    # One batch with three incompatible types of the same column.
    drop(spark.sql("SELECT 2L AS id, 'x' AS n"), feed, "b")
    drop(spark.sql("SELECT 3L AS id, 1.5D AS n, true AS more"), feed, "c")
    drop(spark.sql("SELECT 4L AS id, array(1) AS n"), feed, "d")
    drop(spark.sql("SELECT 5 AS id, 7L AS n"), feed, "e")
    tables = stream.update(spark, feed)
    rows = {r["id"]: r for r in tables.bronze().collect()}
    assert {k: r["n"] for k, r in rows.items()} == {1: 10, 2: None, 3: None, 4: None, 5: 7}
    assert {k: r["_rescued_data"] and json.loads(r["_rescued_data"]) for k, r in rows.items()} == {
        1: None, 2: {"n": "x"}, 3: {"n": "1.5"}, 4: {"n": "[1]"}, 5: None,
    }
    assert rows[3]["more"] is True and rows[1]["more"] is None
    events = read_events(spark, f"{feed.base}/quality_events")
    assert events.agg(F.sum("rows"), F.sum("violations")).first() == (5, 3)


def test_json_drops(spark, tmp_path):
    feed = feed_at(tmp_path, file_format="json")
    text_drop(feed, "a.json", '{"id":1,"a":5,"o":{"x":[1,2]}}\n{"id":2,"a":6}\n')
    stream.update(spark, feed)
    text_drop(feed, "b.json", '{"id":3,"a":1.5,"late":"2024"}\nbroken {\n{"id":"four","a":7,"o":{"x":[3]}}\n')
    rows = stream.update(spark, feed).bronze().collect()
    found = {(r["id"], r["a"]): r for r in rows}
    assert set(found) == {(1, 5), (2, 6), (3, None), (None, None), (None, 7)}
    assert found[(1, 5)]["o"]["x"] == [1, 2] and found[(None, 7)]["o"]["x"] == [3]
    assert json.loads(found[(3, None)]["_rescued_data"]) == {"a": "1.5"}
    assert json.loads(found[(None, 7)]["_rescued_data"]) == {"id": "four"}
    assert json.loads(found[(None, None)]["_rescued_data"]) == {"_corrupt_record": "broken {"}
    assert {r["late"] for r in rows} == {None, 2024} or {r["late"] for r in rows} == {None, "2024"}


def test_csv_drops_with_other_column_order(spark, tmp_path):
    feed = feed_at(tmp_path, file_format="csv")
    text_drop(feed, "a.csv", "id,n,d\n1,10,2024-01-05\n2,x,2024-01-06\n")
    text_drop(feed, "b.csv", "n,id,more\n30,3,true\n40,4\n50,5,false,9\n")
    rows = {r["id"]: r for r in stream.update(spark, feed).bronze().collect()}
    # n holds text in the first file, so both files keep it as text.
    assert {k: r["n"] for k, r in rows.items()} == {1: "10", 2: "x", 3: "30", 4: "40", 5: "50"}
    assert str(rows[1]["d"]) == "2024-01-05" and rows[3]["more"] is True and rows[1]["more"] is None
    assert json.loads(rows[5]["_rescued_data"])["_corrupt_record"] == "50,5,false,9"
    text_drop(feed, "c.csv", "id,d\nsix,2024-02-30\n7,2024-02-29\n")
    late = {str(r["d"]): r for r in stream.update(spark, feed).bronze().filter("n IS NULL").collect()}
    assert json.loads(late["None"]["_rescued_data"]) == {"id": "six", "d": "2024-02-30"}
    assert late["2024-02-29"]["id"] == 7


@pytest.mark.parametrize("file_format", ["csv", "json"])
def test_file_names_are_taken_literally(spark, tmp_path, file_format):
    feed = feed_at(tmp_path, file_format=file_format)
    names = ["a b", "x[1]", "c+d", "e%20f", "{g,h}", "star*"]
    for number, name in enumerate(names):
        text = f"id\n{number}\n" if file_format == "csv" else f'{{"id": {number}}}\n'
        text_drop(feed, f"{name}.{file_format}", text)
    assert sorted(r["id"] for r in stream.update(spark, feed).bronze().collect()) == list(range(len(names)))


def test_an_old_file_that_comes_late_is_read_and_loses(spark, tmp_path):
    feed = feed_at(tmp_path, dedup_keys=("id",))
    drop(spark.sql("SELECT 1 AS id, 'new' AS v"), feed, "a")
    stream.update(spark, feed)
    aside = tmp_path / "aside"
    spark.sql("SELECT * FROM VALUES (1, 'old'), (2, 'only') AS t(id, v)").coalesce(1).write.parquet(str(aside))
    part = next(p for p in aside.iterdir() if p.suffix == ".parquet")
    shutil.copy(part, os.path.join(feed.source, "late.parquet"))
    os.utime(os.path.join(feed.source, "late.parquet"), (10**9, 10**9))
    tables = stream.update(spark, feed)
    assert tables.bronze().count() == 3
    assert sorted((r["id"], r["v"]) for r in tables.silver().collect()) == [(1, "new"), (2, "only")]


@pytest.mark.parametrize("keys", ["", "id"])
def test_a_repeated_micro_batch_adds_nothing(spark, tmp_path, keys):
    feed = feed_at(tmp_path, dedup_keys=keys)
    drop(spark.range(20), feed, "a")
    listing = spark.createDataFrame(
        [(f"{feed.source}/a/{n}", 1) for n in os.listdir(f"{feed.source}/a") if n.endswith(".parquet")],
        "path string, modificationTime int",
    )
    tables = FileTables(spark, feed)
    for _ in range(2):
        tables.apply(listing, 0)
    assert (tables.bronze().count(), tables.silver().count()) == (20, 20)


def test_a_restart_between_bronze_and_silver_finishes_the_batch(spark, tmp_path, monkeypatch):
    feed = feed_at(tmp_path, dedup_keys="id")
    drop(spark.range(20), feed, "a")
    monkeypatch.setattr(FileTables, "_apply_silver", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(Exception, match="lost"):
        stream.update(spark, feed)
    monkeypatch.undo()
    tables = stream.update(spark, feed)
    assert (tables.bronze().count(), tables.silver().count()) == (20, 20)


def test_avro_without_its_package_says_so(spark, tmp_path):
    feed = feed_at(tmp_path, file_format="avro")
    text_drop(feed, "a.avro", "x")
    with pytest.raises(Exception, match="spark-avro"):
        stream.update(spark, feed)


def test_unknown_format_is_refused(tmp_path):
    with pytest.raises(ValueError):
        FileFeed("a", "b", "xml")


def test_a_batch_of_broken_json_is_rescued(spark, tmp_path):
    feed = feed_at(tmp_path, file_format="json")
    text_drop(feed, "a.json", "not json\n\n[broken\n")
    stream.update(spark, feed)
    text_drop(feed, "b.json", '{"id": 1}\n')
    stream.update(spark, feed)
    text_drop(feed, "c.json", "broken again\n")
    rows = stream.update(spark, feed).bronze()
    assert rows.count() == 4 and rows.filter("id IS NOT NULL").count() == 1
    assert rows.filter("_rescued_data IS NOT NULL").count() == 3


def test_files_are_found_by_digest_once(spark, tmp_path):
    source = tmp_path / "drops"
    for number in range(40):
        folder = source / f"a{number % 3}" / f"b{number % 2}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"f{number} é.json").write_text("{}")
    (source / "_temporary").mkdir()
    (source / "_temporary" / "x.json").write_text("{}")
    (source / ".hidden").write_text("{}")
    (source / "other.txt").write_text("")
    listing = list_files(spark, str(source), "*.json")
    assert listing.count() == 40 and listing.select("path").distinct().count() == 40
    assert listing.filter("length <> 2 OR modificationTime < current_timestamp() - INTERVAL 1 DAY").count() == 0
    assert list_files(spark, str(source)).count() == 41 and list_files(spark, str(tmp_path / "none")).count() == 0
    seen, taken = SeenFiles(spark, str(tmp_path / "seen")), []
    while (number := seen.plan(list_files(spark, str(source)), 16)) is not None:
        taken += [r.path for r in seen.files(number).collect()]
    assert sorted(taken) == sorted(r.path for r in list_files(spark, str(source)).collect()) and seen.planned() == 2
    late = source / "a1" / "late.json"
    late.write_text("{}")
    os.utime(late, (1, 1))  # older than any file there was
    assert seen.plan(list_files(spark, str(source)), 16) == 3
    assert [r.path for r in seen.files(3).collect()] == [str(late)]


def test_a_planned_batch_is_worked_on_after_a_lost_job(spark, tmp_path):
    feed = FileFeed(str(tmp_path / "drops"), str(tmp_path / "t"), max_files=2)
    for number in range(5):
        spark.range(number, number + 1).coalesce(1).write.mode("append").parquet(feed.source)
    SeenFiles(spark, f"{feed.base}/seen_files").plan(list_files(spark, feed.source), 2)
    for _ in range(2):
        tables = stream.update_listed(spark, feed)
    assert sorted(r.id for r in tables.bronze().collect()) == list(range(5))


def test_many_paths_stay_out_of_the_driver(spark, tmp_path):
    listing = spark.range(100_000).selectExpr("concat('/drops/', id % 97, '/file-', id) AS path", "timestamp_seconds(id) AS modificationTime", "id AS length")
    seen = SeenFiles(spark, str(tmp_path / "seen"))
    assert seen.plan(listing.filter("length % 10 <> 3"), 200_000) == 0
    assert seen.unseen(listing).count() == 10_000
    assert seen.plan(listing, 100) == 1 and seen.files(1).agg({"length": "max"}).first()[0] == 993
