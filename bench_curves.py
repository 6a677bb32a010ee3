"""How the keyed table, the reduction per key and the daily counts scale. Prints one line each.

``BENCH_SF_DIR`` names the data; every state is made of ``lineitem`` rows.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Window as W  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

KEYS, SEQUENCE = ["id"], ["version"]


def timed(action):
    started = time.perf_counter()
    result = action()
    return round(time.perf_counter() - started, 2), result


def drain(df):
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    from sluiceway.operators.changes import latest_per_key
    from sluiceway.plans.gold import refresh_counts, records_per_day
    from sluiceway.session import build_session, scratch_path
    from sluiceway.streaming.keyed_table import KeyedTable

    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": "16",
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        F.lit(0).alias("version"),
        F.to_date("l_shipdate").alias("ingest_date"),
        F.col("l_returnflag").alias("endpoint"),
        "l_extendedprice",
    )
    newer = rows.withColumn("version", F.lit(1)).withColumn("ingest_date", F.lit("2002-01-01").cast("date"))
    drain(latest_per_key(rows, KEYS, SEQUENCE))

    for part in (100, 10, 1):
        for buckets, what in ((16, "all buckets"), (256, "few buckets")):
            table = KeyedTable(spark, scratch_path(spark, "curve"), KEYS, SEQUENCE, buckets=buckets)
            build, _ = timed(lambda: table.upsert(rows.filter(F.col("id") % 100 < part), "q", 0))
            batch = newer.filter((F.col("id") % 100 == 0) & (F.col("id") % 10000 < 200 if buckets == 256 else F.lit(True)))
            apply, _ = timed(lambda: table.upsert(batch, "q", 1))
            commit = table.commit(1)
            read, _ = timed(lambda: drain(table.read()))
            print(
                f"upsert state={table.read(0).count()} {what}: build {build}s, batch {apply}s, "
                f"{commit['bytes']['1']} bytes in {len(commit['written'])} of {buckets} buckets, read {read}s",
                flush=True,
            )

    both = rows.unionByName(newer)
    order = W.partitionBy(*KEYS).orderBy(F.col("version").desc(), F.col("ingest_date").desc())
    for name, df in (
        ("max_by", latest_per_key(both, KEYS, SEQUENCE)),
        ("row_number", both.withColumn("n", F.row_number().over(order)).filter("n = 1")),
    ):
        print(f"latest per key, {name}: {min(timed(lambda: drain(df))[0] for _ in range(3))}s", flush=True)

    table = KeyedTable(spark, scratch_path(spark, "curve"), KEYS, SEQUENCE, buckets=16)
    table.upsert(rows, "q", 0)
    path = scratch_path(spark, "counts")
    records_per_day(table.read()).write.parquet(path)
    counts = spark.read.parquet(path)
    for number, share in enumerate((1000, 100, 10), start=1):
        table.upsert(newer.withColumn("version", F.lit(number)).filter(F.col("id") % share == 0), "q", number)
        changes = table.changes(number - 1)
        by = ["ingest_date", "endpoint"]
        delta = min(timed(lambda: drain(refresh_counts(counts, changes, by)))[0] for _ in range(3))
        full = min(timed(lambda: drain(records_per_day(table.read())))[0] for _ in range(3))
        print(f"daily counts, 1/{share} of keys changed: from changes {delta}s, in full {full}s", flush=True)


if __name__ == "__main__":
    main()
