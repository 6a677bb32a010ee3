"""Apply changes to keyed tables: current state, history, deletes, differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sluiceway.functions.rows import all_present, comparable, row_hash, sequence_order

DELETED = "_deleted"


def mark_deletes(df: DataFrame, delete_when: str | Column | None) -> DataFrame:
    """Adds ``_deleted``, or keeps the one there is; an unknown condition is not a delete."""
    if delete_when is None:
        condition = F.col(DELETED) if DELETED in df.columns else F.lit(False)
    else:
        condition = F.expr(delete_when) if isinstance(delete_when, str) else delete_when
    return df.withColumn(DELETED, F.coalesce(condition, F.lit(False)))


def latest_per_key(df: DataFrame, keys: Sequence[str], sequence_by: Sequence[str]) -> DataFrame:
    """The newest row per key. Rows with a NULL key are left out.

    An aggregate, not a window: it reduces each key before the shuffle, so a key that holds a
    third of all rows sends one row per map task.
    """
    rest = [c for c in df.columns if c not in keys]
    order = sequence_order(df, sequence_by)
    newest = (
        df.filter(all_present(keys))
        .groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), order).alias("_row"))
    )
    return newest.select(*[c if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def current_state(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: Sequence[str],
    delete_when: str | Column | None = None,
) -> DataFrame:
    """SCD type 1 over a whole change set: the newest row per key, unless that is a delete."""
    if delete_when is None:
        return latest_per_key(changes, keys, sequence_by)
    newest = latest_per_key(mark_deletes(changes, delete_when), keys, sequence_by)
    return newest.filter(~F.col(DELETED)).drop(DELETED)


def missing_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows ``latest_per_key`` leaves out, to be counted."""
    return df.filter(~all_present(keys))


def _halving_steps(cuts: Column) -> Column:
    """Powers of two, descending, that together reach every position of the array."""
    largest = F.floor(F.log2(F.size(cuts).cast("double"))).cast("int")
    return F.transform(F.sequence(largest, F.lit(0), F.lit(-1)), lambda e: F.pow(F.lit(2), e).cast("int"))


def _count_up_to(cuts: Column, steps: Column, value: Column) -> Column:
    """How many of the sorted cuts are not above the value, in as many steps as the size has bits."""
    return F.aggregate(
        steps,
        F.lit(0),
        lambda found, step: F.when(F.get(cuts, found + step - 1) <= value, found + step).otherwise(found),
    )


def chained(df: DataFrame, keys: Sequence[str], sequence: str, piece_rows: int) -> DataFrame:
    """Adds ``_next``: the sequence of the following row of the same key, in a struct.

    Each sequence comes once in a key.

    A window per key would put a hot key into one task. Therefore about one in ``piece_rows``
    sequences, chosen by the hash of key and sequence, starts a new piece of its key, and the
    window runs inside pieces. What follows the last row of a piece is the start of the next one,
    which is known. There are about ``rows / piece_rows`` starts in all, whatever the keys look
    like. A key with few rows hardly ever has one.
    """
    here = F.struct(F.col(sequence).alias("v"))
    starts = F.pmod(F.xxhash64(*keys, sequence), F.lit(piece_rows)) == 0
    cuts = (
        df.filter(F.col(sequence).isNotNull() & starts)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_set(sequence)).alias("_cuts"))
        .withColumn("_steps", _halving_steps(F.col("_cuts")))
    )
    found = _count_up_to(F.col("_cuts"), F.col("_steps"), F.col(sequence))
    inside = F.col("_cuts").isNull() | F.col(sequence).isNull()
    pieces = (
        df.join(cuts, list(keys), "left")
        .withColumn("_piece", F.when(inside, 0).otherwise(found))
        .withColumn("_beyond", F.get("_cuts", F.col("_piece")))
        .drop("_cuts", "_steps")
    )
    following = F.lead(here).over(W.partitionBy(*keys, "_piece").orderBy(here))
    start = F.when(F.col("_beyond").isNotNull(), F.struct(F.col("_beyond").alias("v")))
    return pieces.withColumn("_next", F.coalesce(following, start)).drop("_piece", "_beyond")


def newest_per_sequence(rows: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """One row per key and sequence, that of the greatest hash.

    An aggregate: a coarse sequence (a date, or NULL) can hold a large part of a key, and no cut of
    ``chained`` falls inside one value.
    """
    rest = [c for c in rows.columns if c not in (*keys, sequence)]
    kept = F.max_by(F.struct(*rest), row_hash(rows, sorted(rows.columns))).alias("_row")
    return rows.groupBy(*keys, sequence).agg(kept).select(*keys, sequence, "_row.*").select(*rows.columns)


def history(
    changes: DataFrame,
    keys: Sequence[str],
    sequence: str,
    delete_when: str | Column | None = None,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    piece_rows: int = 1_000_000,
) -> DataFrame:
    """SCD type 2: every version of a key with the sequence range in which it held.

    The open version has a NULL end. A delete closes the version before it and is no version
    itself. Of several rows with one key and sequence, the greatest hash stays.
    """
    rows = newest_per_sequence(mark_deletes(changes.filter(all_present(keys)), delete_when), keys, sequence)
    return (
        chained(rows, keys, sequence, piece_rows)
        .filter(~F.col(DELETED))
        .withColumn(valid_from, F.col(sequence))
        .withColumn(valid_to, F.col("_next.v"))
        .drop("_next", DELETED)
    )


def open_versions(versions: DataFrame, valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Current state out of a history."""
    return versions.filter(F.col(valid_to).isNull()).drop(valid_from, valid_to)


def append_only(changes: DataFrame, delete_when: str | Column | None = None) -> DataFrame:
    """Every change kept as it came; deletes have no row to append."""
    if delete_when is None:
        return changes
    return mark_deletes(changes, delete_when).filter(~F.col(DELETED)).drop(DELETED)


def hard_deleted(state: DataFrame, key_snapshot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the state whose key is gone from a snapshot of the source's keys."""
    return state.join(key_snapshot.select(*keys), list(keys), "left_anti")


def apply_hard_deletes(state: DataFrame, key_snapshot: DataFrame, keys: Sequence[str]) -> DataFrame:
    return state.join(key_snapshot.select(*keys), list(keys), "left_semi")


def table_changes(
    before: DataFrame, after: DataFrame, keys: Sequence[str], ignore: Sequence[str] = ()
) -> DataFrame:
    """Row-level difference of two states: ``_change`` is insert, update or delete.

    Carries both images as the structs ``_before`` and ``_after``. Columns in ``ignore`` do not
    make an update.
    """
    columns = [c for c in after.columns if c not in keys]
    watched = [c for c in columns if c not in ignore and c in before.columns]
    added = [c for c in columns if c not in ignore and c not in before.columns]

    def image(df: DataFrame, name: str) -> DataFrame:
        present = [c for c in df.columns if c not in keys]
        marks = [comparable(df, c).alias(c) for c in watched]
        marks += [comparable(df, c).alias(c) if c in df.columns else F.lit(None).alias(c) for c in added]
        # A leading literal keeps the struct non-NULL when there is nothing to watch.
        return df.select(
            *keys,
            F.struct(*present).alias(f"_{name}"),
            F.struct(F.lit(1).alias("_"), *marks).alias(f"_{name}_marks"),
        )

    old, new = image(before, "before"), image(after, "after")
    change = (
        F.when(F.col("_before").isNull(), "insert")
        .when(F.col("_after").isNull(), "delete")
        .otherwise("update")
    )
    return (
        old.join(new, list(keys), "full_outer")
        .filter(~F.col("_before_marks").eqNullSafe(F.col("_after_marks")))
        .withColumn("_change", change)
        .select(*keys, "_change", "_before", "_after")
    )
