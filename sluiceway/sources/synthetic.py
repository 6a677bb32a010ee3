"""Demo drops with known content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Regions of the demo orders, taken by order_id modulo 4.
REGIONS = ("north", "south", "east", "west")


def demo_orders(ids: DataFrame, id_column: str = "id", order_ts: Column | None = None) -> DataFrame:
    """Demo orders for given ids."""
    stamp = F.current_timestamp() if order_ts is None else order_ts
    numbered = ids.select(F.col(id_column).alias("order_id"), stamp.alias("order_ts"))
    regions = F.array(*map(F.lit, REGIONS))
    return numbered.select(
        "order_id",
        F.get(regions, F.pmod("order_id", F.lit(len(REGIONS))).cast("int")).alias("region"),
        F.expr("order_id * 10.5D").alias("amount"),
        "order_ts",
    )


def write_one_file(df: DataFrame, path: str) -> None:
    """Replace a drop by exactly one file; meant for drops of demo size."""
    df.coalesce(1).write.mode("overwrite").parquet(path)


def read_drops(spark: SparkSession, *paths: str) -> DataFrame:
    """Exactly the named drops; nothing is taken from directory names."""
    return spark.read.parquet(*paths)


def seed_demo(spark: SparkSession, target: str) -> int:
    """Two drops of 60 and 40 orders; raises unless 100 rows can be read back."""
    # First id and row count of each drop.
    drops = {"batch_001": (1, 60), "batch_002": (61, 40)}
    for name, (start, count) in drops.items():
        write_one_file(demo_orders(spark.range(start, start + count)), f"{target}/{name}")
    total = read_drops(spark, *[f"{target}/{name}" for name in drops]).count()
    if total != sum(count for _, count in drops.values()):
        raise RuntimeError(f"seeded drops under {target} hold {total} rows")
    return total
