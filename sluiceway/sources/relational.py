"""Pulls and change feeds from relational tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.functions.rows import row_hash


#: Fixed value: how long staged changes are kept.
RETENTION_DAYS = 30


@dataclass(frozen=True)
class TableSpec:
    """How one source table is ingested."""

    name: str
    primary_keys: tuple[str, ...]
    cursor: str | None = None
    scd_type: int | str = 1
    delete_when: str | None = None
    retention_days: int = RETENTION_DAYS

    def __post_init__(self):
        if self.scd_type not in (1, 2, "append"):
            raise ValueError(f"{self.name}: scd_type is 1, 2 or 'append', not {self.scd_type!r}")
        if not self.primary_keys and self.scd_type != "append":
            raise ValueError(f"{self.name}: primary keys are needed")
        if self.scd_type == 2 and not self.cursor:
            raise ValueError(f"{self.name}: a history needs a cursor to order its versions")
        if self.cursor and self.cursor in self.primary_keys:
            raise ValueError(
                f"{self.name}: cursor {self.cursor} is a primary key, which does not move on an "
                "update; such a pull misses every change to an existing row"
            )


@dataclass(frozen=True)
class JdbcSource:
    """A relational database behind a JDBC driver on the cluster."""

    url: str
    options: Mapping[str, str] = field(default_factory=dict)

    def reader_options(
        self, table: str, split_on: str | None = None, low=None, high=None, splits: int = 1
    ) -> dict[str, str]:
        chosen = {"url": self.url, "dbtable": table, **self.options}
        if split_on and splits > 1:
            chosen |= {
                "partitionColumn": split_on,
                "lowerBound": str(low),
                "upperBound": str(high),
                "numPartitions": str(splits),
            }
        return chosen

    def read(self, spark: SparkSession, table: str, **split) -> DataFrame:
        """A lazy scan: filters and columns that follow are sent to the database."""
        return spark.read.format("jdbc").options(**self.reader_options(table, **split)).load()


def schema_specs(
    spark: SparkSession, database: str, primary_keys: Mapping[str, Sequence[str]], **settings
) -> list[TableSpec]:
    """One spec per table of a whole schema; every table needs its primary keys named."""
    names = sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)
    unnamed = [n for n in names if n not in primary_keys]
    if unnamed:
        raise ValueError(f"no primary keys for {', '.join(unnamed)}")
    return [TableSpec(n, tuple(primary_keys[n]), **settings) for n in names]


def pull(source: DataFrame, cursor: str | None, watermark=None) -> DataFrame:
    """Rows whose cursor moved past the watermark; everything without a cursor or watermark."""
    if cursor is None or watermark is None:
        return source
    mark = watermark if isinstance(watermark, Column) else F.lit(watermark)
    return source.filter(F.col(cursor) > mark)


def next_watermark(pulled: DataFrame, cursor: str, watermark=None):
    """The cursor to continue from, unchanged when nothing came."""
    found = pulled.agg(F.max(cursor)).first()[0]
    return watermark if found is None else found


def stored_watermark(pulled: DataFrame, cursor: str, before: dict | None = None) -> dict | None:
    """The cursor to continue from as JSON can hold it: text and its Spark type."""
    kind = pulled.schema[cursor].dataType.simpleString()
    value = F.max(cursor)
    found = pulled.agg(F.hex(value) if kind == "binary" else value.cast("string")).first()[0]
    return before if found is None else {"text": found, "type": kind}


def watermark_column(stored: dict | None) -> Column | None:
    """A stored watermark in the type it was read with."""
    if stored is None:
        return None
    text = F.lit(stored["text"])
    return F.unhex(text) if stored["type"] == "binary" else text.cast(stored["type"])


def change_feed(
    snapshot: DataFrame, events: DataFrame, sequence: str, op: str = "op", start: Column | None = None
) -> DataFrame:
    """An initial snapshot followed by captured changes, in one shape.

    Snapshot rows get ``op`` 's' and a sequence below every change (NULL unless given).
    """
    kind = events.schema[sequence].dataType
    first = F.lit(None).cast(kind) if start is None else start.cast(kind)
    initial = snapshot.withColumn(op, F.lit("s")).withColumn(sequence, first)
    return initial.unionByName(events, allowMissingColumns=True)


def retained(feed: DataFrame, committed_at: str, as_of: Column, days: int = RETENTION_DAYS) -> DataFrame:
    """Staged changes young enough to be replayed."""
    return feed.filter(F.col(committed_at) >= as_of - F.make_dt_interval(F.lit(days)))


def needs_resnapshot(
    feed: DataFrame, reprocess_from: Column, committed_at: str, as_of: Column, days: int = RETENTION_DAYS
) -> DataFrame:
    """Whether reprocessing from a point would need changes older than what is staged."""
    oldest = as_of - F.make_dt_interval(F.lit(days))
    return feed.agg(
        F.count_if(F.col(committed_at) < oldest).alias("expired_changes"),
        F.count_if(F.col(committed_at) >= oldest).alias("retained_changes"),
    ).withColumn("resnapshot_needed", reprocess_from < oldest)


def audit_cursor(
    before: DataFrame, after: DataFrame, keys: Sequence[str], cursor: str
) -> DataFrame:
    """Keys whose row changed while the cursor stood still: updates that a pull misses."""
    columns = sorted(c for c in after.columns if c not in (*keys, cursor))

    def marks(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            *keys, F.col(cursor).alias(f"{name}_cursor"), row_hash(df, columns).alias(f"{name}_hash")
        )

    return (
        marks(before, "old")
        .join(marks(after, "new"), list(keys))
        .filter(F.col("old_cursor").eqNullSafe(F.col("new_cursor")) & (F.col("old_hash") != F.col("new_hash")))
        .select(*keys, F.col("new_cursor").alias(cursor))
    )
