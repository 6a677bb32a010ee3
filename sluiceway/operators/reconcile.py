"""Find what differs between two copies of a table without moving what is alike."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.rows import all_present, row_hash
from sluiceway.session import scratch_path

_PLACE, _RANGE = "_place", "_range"


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _place(df: DataFrame, keys: Sequence[str]) -> Column:
    """Where a row stands on a line: at its key if that is a whole number, else at a hash of the keys."""
    if len(keys) == 1 and isinstance(df.schema[keys[0]].dataType, T.IntegralType):
        return F.col(keys[0]).cast("bigint")
    return F.shiftrightunsigned(F.xxhash64(*keys), 1)


def _checksums(rows: DataFrame, width: int, low: int, name: str) -> DataFrame:
    """Per range of places: how many rows, and two sums of their hashes that no order changes."""
    number = F.expr(f"cast((cast({_PLACE} as decimal(20,0)) - {low}BD) div {width}BD as bigint)")
    sums = F.struct(
        F.count(F.lit(1)).alias("n"), F.bit_xor("_hash").alias("x"),
        F.sum(F.xxhash64("_hash", F.lit(7)).cast("decimal(38,0)")).alias("s"),
    )
    return rows.groupBy(number.alias(_RANGE)).agg(sums.alias(name))


def differing_rows(
    left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str],
    *, fanout: int = 1_024, leaf_rows: int = 64,
) -> tuple[DataFrame, DataFrame]:
    """The rows of both tables that lie in ranges of keys in which the tables differ.

    A tree of checksums over ranges of keys: at each level both sides are added up per range, which
    sends a row for each range and task, and only ranges that differ are looked into at the next level, until none
    of them holds more than ``leaf_rows`` rows on a side, or a range is one place. A range filter goes to the scan, so sorted sources skip what is alike.
    Rows with a NULL key are left out. ``columns`` are those in which two rows of a key can differ.
    """
    sides = [
        df.filter(all_present(keys)).withColumns({_PLACE: _place(df, keys), "_hash": row_hash(df, [*keys, *columns])})
        for df in (left, right)
    ]
    spans = [df.agg(F.min(_PLACE).alias("low"), F.max(_PLACE).alias("high"), F.count(F.lit(1)).alias("n")).first() for df in sides]
    spans = [s for s in spans if s["n"]]
    if not spans:
        return tuple(df.drop(_PLACE, "_hash") for df in sides)
    low, high = min(s["low"] for s in spans), max(s["high"] for s in spans)
    width, most = high - low + 1, None
    while most is None or (most > leaf_rows and width > 1):
        if most is not None:
            sides = [_inside(df, found, width, low) for df in sides]
        width = -(-width // fanout)
        one, two = (_checksums(df, width, low, name) for df, name in zip(sides, ("one", "two")))
        unlike = one.join(two, _RANGE, "full_outer").filter(~F.col("one").eqNullSafe(F.col("two")))
        found = _stored(unlike.select(_RANGE, F.greatest("one.n", "two.n").alias("n")), "reconcile-ranges")
        most = found.agg(F.max("n")).first()[0] or 0
    return tuple(_inside(df, found, width, low).drop(_PLACE, "_hash") for df in sides)


def _inside(rows: DataFrame, ranges: DataFrame, width: int, low: int) -> DataFrame:
    """The rows in the given ranges; their outermost bounds are a filter that the scan can use."""
    first, last = ranges.agg(F.min(_RANGE), F.max(_RANGE)).first()
    if first is None:
        return rows.filter(F.lit(False))
    number = F.expr(f"cast((cast({_PLACE} as decimal(20,0)) - {low}BD) div {width}BD as bigint)")
    bounded = rows.filter((F.col(_PLACE) >= low + first * width) & (F.col(_PLACE) <= min(low + (last + 1) * width - 1, (1 << 63) - 1)))
    return bounded.withColumn(_RANGE, number).join(ranges, _RANGE, "left_semi").drop(_RANGE)


def reconcile(before: DataFrame, after: DataFrame, keys: Sequence[str], ignore: Sequence[str] = (), **tree) -> DataFrame:
    """``(keys, _change)`` of all keys that are new, gone or changed: insert, delete or update.

    Columns that only one side has, and those in ``ignore``, do not make an update. Only rows of differing ranges
    meet in a join. Several rows of a key differ if their hashes, taken together, do.
    """
    columns = sorted(c for c in after.columns if c in before.columns and c not in (*keys, *ignore))
    marks = []
    for df, name in zip(differing_rows(before, after, keys, columns, **tree), ("old", "new")):
        hashes = F.array_sort(F.collect_list(row_hash(df, columns) if columns else F.lit(0).cast("bigint")))
        marks.append(df.groupBy(*keys).agg(hashes.alias(name)))
    change = F.when(F.col("old").isNull(), "insert").when(F.col("new").isNull(), "delete").otherwise("update")
    joined = marks[0].join(marks[1], list(keys), "full_outer").filter(~F.col("old").eqNullSafe(F.col("new")))
    return joined.select(*keys, change.alias("_change"))


def bitmap_deleted(state: DataFrame, key_snapshot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the state whose key is gone from a snapshot of the source's keys.

    Keys that are one whole number are compared as bitmaps of 32,768 numbers each: a bitmap is made
    where the rows are, and only rows whose bitmaps differ are joined by key. Other keys are joined outright.
    """
    whole = len(keys) == 1 and all(isinstance(df.schema[keys[0]].dataType, T.IntegralType) for df in (state, key_snapshot))
    snapshot = key_snapshot.select(*keys)
    if not whole:
        return state.join(snapshot, list(keys), "left_anti")
    key, part = F.col(keys[0]).cast("bigint"), "_part"

    def bitmaps(df: DataFrame, name: str) -> DataFrame:
        bits = F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias(name)
        return df.filter(key.isNotNull()).groupBy(F.bitmap_bucket_number(key).alias(part)).agg(bits)

    both = bitmaps(state, "held").join(bitmaps(snapshot, "there"), part, "left")
    unlike = both.filter(~F.col("held").eqNullSafe(F.col("there"))).select(part)
    held = state.withColumn(part, F.bitmap_bucket_number(key))
    # A NULL key is in no bitmap, and in no snapshot that could keep its row.
    doubtful = held.join(unlike, part, "left_semi").drop(part)
    there = snapshot.withColumn(part, F.bitmap_bucket_number(key)).join(unlike, part, "left_semi").drop(part)
    return reduce(DataFrame.unionAll, [doubtful.join(there, list(keys), "left_anti"), state.filter(key.isNull())])
