"""Expressions over whole rows: comparable forms, hashes, ordering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _has(kind, data_type: T.DataType) -> bool:
    if isinstance(data_type, kind):
        return True
    if isinstance(data_type, T.ArrayType):
        return _has(kind, data_type.elementType)
    if isinstance(data_type, T.StructType):
        return any(_has(kind, field.dataType) for field in data_type)
    return False


def comparable(df: DataFrame, name: str) -> Column:
    """The column in a form that can be hashed and compared: VARIANT and MAP turn into JSON."""
    kind = df.schema[name].dataType
    column = F.col(f"`{name}`")
    return F.to_json(column) if _has((T.VariantType, T.MapType), kind) else column


def row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """A 64-bit hash over the named columns that tells NULL in one column from NULL in another."""
    parts: list[Column] = []
    for position, name in enumerate(columns):
        part = comparable(df, name)
        parts += [part, F.when(part.isNull(), F.lit(position))]
    return F.xxhash64(*parts)


def sequence_order(df: DataFrame, sequence_by: Sequence[str]) -> Column:
    """What makes one change newer than another with the same key.

    First the sequence columns, then the ingest stamp, then a hash of the row, so that the winner
    does not depend on the order in which rows arrive. Wrapped in a struct because NULL sorts
    lowest inside a struct, while a bare NULL ordering would lose the row.
    """
    parts = [F.col(f"`{name}`").alias(f"s{i}") for i, name in enumerate(sequence_by)]
    if "_ingested_at" in df.columns and "_ingested_at" not in sequence_by:
        parts.append(F.col("_ingested_at").alias("stamp"))
    parts.append(row_hash(df, sorted(df.columns)).alias("tie"))
    return F.struct(*parts)


def all_present(columns: Sequence[str]) -> Column:
    condition = F.lit(True)
    for name in columns:
        condition = condition & F.col(f"`{name}`").isNotNull()
    return condition
