import os

import pytest
from pyspark.sql import functions as F

from sluiceway.plans.gold import distinct_counts, distinct_sketches
from sluiceway.plans.tables import hilbert, space_filled


@pytest.mark.parametrize(("dimensions", "bits"), [(2, 4), (3, 2)])
def test_the_curve_visits_every_cell_and_steps_to_a_neighbour(spark, dimensions, bits):
    names = [f"c{i}" for i in range(dimensions)]
    cells = spark.range(1 << bits * dimensions).select(*[F.shiftright("id", bits * i).bitwiseAND(F.lit((1 << bits) - 1)).alias(n) for i, n in enumerate(names)])
    placed = hilbert(cells, names, bits, "place")
    assert placed.columns == [*names, "place"]
    walk = [tuple(r) for r in placed.orderBy("place").collect()]
    assert [r[-1] for r in walk] == list(range(1 << bits * dimensions))
    assert all(sum(abs(a - b) for a, b in zip(one[:-1], two[:-1])) == 1 for one, two in zip(walk, walk[1:]))


def test_a_layout_serves_filters_on_either_column(spark, tmp_path):
    rows = spark.range(40_000).selectExpr(
        "concat('/e/', lpad(pmod(xxhash64(id), 200), 3, '0')) AS endpoint", "IF(id % 500 = 0, NULL, date_add(date'2024-01-01', cast(pmod(xxhash64(id, 1), 300) AS int))) AS day", "id"
    )
    space_filled(rows, ["endpoint", "day"], 64).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert stored.exceptAll(rows).count() == 0 and stored.count() == 40_000
    for column in ("endpoint", "day"):
        per_file = stored.groupBy(F.col("_metadata.file_path")).agg(F.min(column).alias("low"), F.max(column).alias("high")).collect()
        value = sorted(r[0] for r in rows.select(column).distinct().collect() if r[0] is not None)[137]
        assert 50 <= len(per_file) <= 64
        assert sum(r["low"] <= value <= r["high"] for r in per_file) <= 20


def test_one_hot_cell_is_split_over_files(spark, tmp_path):
    rows = spark.range(8_000).selectExpr("'same' AS endpoint", "date'2024-01-01' AS day", "id")
    space_filled(rows, ["endpoint", "day"], 8).write.parquet(str(tmp_path / "t"))
    sizes = [r["count"] for r in spark.read.parquet(str(tmp_path / "t")).groupBy("_metadata.file_path").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 2_500
    assert space_filled(rows.limit(0), ["endpoint", "day"], 8).count() == 0


def test_a_new_day_adds_its_sketch_alone(spark, tmp_path):
    path = str(tmp_path / "s")
    days = [spark.range(i * 3_000, i * 3_000 + 9_000).selectExpr(f"{i} AS day", "IF(id % 10 = 0, NULL, id) AS user") for i in range(3)]
    for rows in days:
        distinct_sketches(rows, ["day"], "user").write.mode("append").partitionBy("day").parquet(path)
    assert len([d for d in os.listdir(path) if d.startswith("day=")]) == 3
    found = distinct_counts(spark.read.parquet(path), []).first()
    exact = days[0].unionAll(days[1]).unionAll(days[2]).select(F.countDistinct("user")).first()[0]
    assert abs(found["distinct_estimate"] - exact) <= 0.02 * exact and found["rows"] == 27_000
    two = distinct_counts(spark.read.parquet(path).filter("day < 2"), []).first()["distinct_estimate"]
    assert abs(two - 10_800) <= 216
