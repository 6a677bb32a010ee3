"""Run queries beside their SQL in DuckDB: ``python tests/compare.py <sf_dir> [names]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def rows_of(cursor_or_df) -> tuple[list[str], list[tuple]]:
    """Column names in order, and rows in a canonical order."""
    if hasattr(cursor_or_df, "collect") and hasattr(cursor_or_df, "schema"):
        names, rows = cursor_or_df.columns, [tuple(r) for r in cursor_or_df.collect()]
    else:
        names, rows = [d[0] for d in cursor_or_df.description], cursor_or_df.fetchall()
    order = sorted(range(len(names)), key=names.__getitem__)
    shaped = [tuple(row[i] for i in order) for row in rows]
    return [names[i] for i in order], sorted(shaped, key=lambda r: [(v is not None, str(v)) for v in r])


def differences(left, right, limit: int = 3) -> list[str]:
    (names, rows), (expected_names, expected) = left, right
    found = []
    if names != expected_names:
        found.append(f"columns {names} != {expected_names}")
    if len(rows) != len(expected):
        found.append(f"{len(rows)} rows != {len(expected)}")
    for row, wanted in zip(rows, expected):
        if len(found) >= limit:
            break
        if row != wanted or [type(v) for v in row] != [type(v) for v in wanted]:
            found.append(f"{row} != {wanted}")
    return found


def main() -> int:
    from __spark_entry__ import oracle_sql, queries

    from sluiceway.session import build_session

    sf_dir, chosen = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
                       "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    sql = oracle_sql()
    for name, run in queries().items():
        if chosen and name not in chosen:
            continue
        started = time.time()
        try:
            mine = rows_of(run(spark, sf_dir))
            took = time.time() - started
            found = differences(mine, rows_of(con.execute(sql[name]))) if name in sql else ["no SQL"]
        except Exception as problem:
            took, mine, found = time.time() - started, ([], []), [repr(problem)[:600]]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name:34s} {len(mine[1]):7d} rows {took:6.2f}s", flush=True)
        for line in found:
            print("      ", line[:400])
    return failed


if __name__ == "__main__":
    sys.exit(main())
