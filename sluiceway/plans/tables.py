"""Batch table writes."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.rows import row_hash
from sluiceway.storage import Folder


def clustered(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows laid out by scalar columns, so that file statistics can skip files.

    The row hash ends the range key: a value that holds a third of all rows is split over many
    ranges instead of filling one task.
    """
    spread = df.withColumn("_spread", row_hash(df, sorted(df.columns)))
    return spread.repartitionByRange(*by, "_spread").sortWithinPartitions(*by).drop("_spread")


def hilbert(df: DataFrame, columns: Sequence[str], bits: int, name: str) -> DataFrame:
    """Adds the place of a point on the Hilbert curve through a cube of ``2**bits`` cells a side.

    ``columns`` hold whole numbers from 0 below that. What lies near on the curve is near in every
    coordinate. The rule is Skilling's: from the top bit down, a coordinate whose bit is set flips
    the lower bits of the first one, else the two swap the bits in which they differ; a Gray code
    then orders the corners. All of it is shifts and exclusive ors in generated code.
    """
    x, last = [f"{name}_{i}" for i in range(len(columns))], len(columns) - 1
    df = df.withColumns({c: F.col(f"`{source}`").cast("bigint") for c, source in zip(x, columns)})
    for bit in range(bits - 1, 0, -1):
        low = F.lit((1 << bit) - 1).cast("bigint")
        for c in x:
            is_set = F.col(c).bitwiseAND(F.lit(1 << bit)) != 0
            swap = F.col(x[0]).bitwiseXOR(F.col(c)).bitwiseAND(low)
            moved = {x[0]: F.col(x[0]).bitwiseXOR(F.when(is_set, low).otherwise(swap))}
            if c != x[0]:
                moved[c] = F.when(is_set, F.col(c)).otherwise(F.col(c).bitwiseXOR(swap))
            df = df.withColumns(moved)
    for before, c in zip(x, x[1:]):
        df = df.withColumn(c, F.col(c).bitwiseXOR(F.col(before)))
    turn = F.lit(0).cast("bigint")
    for bit in range(bits - 1, 0, -1):
        turn = turn.bitwiseXOR(F.when(F.col(x[last]).bitwiseAND(F.lit(1 << bit)) != 0, (1 << bit) - 1).otherwise(0))
    df = df.withColumn(f"{name}_turn", turn).withColumns({c: F.col(c).bitwiseXOR(F.col(f"{name}_turn")) for c in x})
    place = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, c in enumerate(x):
            place = place + F.shiftleft(F.shiftright(F.col(c), bit).bitwiseAND(F.lit(1)), bit * len(x) + last - i)
    return df.withColumn(name, place).drop(*x, f"{name}_turn")


def _in_steps(df: DataFrame, column: str, steps: int, name: str) -> DataFrame:
    """Adds the number of the part, out of ``steps`` in the order of a column, that a row's value lies in.

    Numbers, dates and times are cut at percentiles of the rows (one row of them reaches the driver), NULL
    lies in the first part. Text is cut so that each part has about as many distinct values, of which
    there should be few beside the rows.
    """
    kind, value = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        value = F.unix_micros(value.cast("timestamp"))
    elif not isinstance(kind, T.NumericType):
        ranges = df.select(value.alias(f"{name}_of")).distinct().repartitionByRange(steps, f"{name}_of")
        ranges = ranges.withColumn(name, F.spark_partition_id().cast("bigint"))
        return df.join(ranges, value.eqNullSafe(F.col(f"{name}_of"))).drop(f"{name}_of")
    value = value.cast("double")
    cuts = df.agg(F.percentile_approx(value, [i / steps for i in range(1, steps)], 20 * steps)).first()[0]
    below = F.size(F.filter(F.lit(sorted(set(cuts or []))).cast("array<double>"), lambda c: c < value))
    return df.withColumn(name, F.when(value.isNull(), 0).otherwise(below).cast("bigint"))


def space_filled(df: DataFrame, by: Sequence[str], files: int, bits: int = 6) -> DataFrame:
    """Rows laid out along a Hilbert curve through their values, in ``files`` parts of about equal size.

    A filter on any one of the columns then touches about ``files ** (1 - 1 / columns)`` files, where an order
    by the first column serves that one alone. A row hash ends the range key, so that one cell with a third of all rows
    is split. Each column is cut into ``2**bits`` steps.
    """
    names = [f"_cell{i}" for i in range(len(by))]
    spread, placed = row_hash(df, sorted(df.columns)), df
    for column, name in zip(by, names):
        placed = _in_steps(placed, column, 1 << bits, name)
    placed = hilbert(placed, names, bits, "_curve").withColumn("_spread", spread)
    return placed.repartitionByRange(files, "_curve", "_spread").sortWithinPartitions(*by).select(*[f"`{c}`" for c in df.columns])


def refresh_view(df: DataFrame, path: str, cluster_by: Sequence[str] = ()) -> None:
    """Recompute a gold table in full; ``read_view`` sees the old rows until all new ones are there.

    Each refresh has a folder of its own, and the note published last names the folder to read. The
    folder before stays for those who are still reading it, older ones go.
    """
    spark = df.sparkSession
    folder = Folder(spark, path)
    notes = folder.names("_notes")
    number = int(notes[-1]) + 1 if notes else 0
    target = f"rows-{number:010d}-{uuid.uuid4().hex[:8]}"
    (clustered(df, cluster_by) if cluster_by else df).write.parquet(f"{path}/{target}")
    folder.publish(f"_notes/{number:010d}", target)
    kept = {target, *(folder.read(f"_notes/{n}") for n in notes[-1:])}
    for name in notes[:-1]:
        folder.remove(f"_notes/{name}")
    for name in folder.names():
        # Later refreshes belong to other writers.
        if name.startswith("rows-") and name[:15] <= target[:15] and name not in kept:
            folder.remove(name)


def read_view(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the latest finished refresh."""
    folder = Folder(spark, path)
    notes = folder.names("_notes")
    if not notes:
        raise FileNotFoundError(f"{path} was never refreshed")
    return spark.read.parquet(f"{path}/{folder.read(f'_notes/{notes[-1]}')}")
