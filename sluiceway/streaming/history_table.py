"""A stored history (SCD type 2): batches are spliced into the intervals that they touch."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.rows import all_present
from sluiceway.operators.changes import DELETED, chained, mark_deletes, newest_per_sequence
from sluiceway.storage import Folder

UNTIL, BUCKET, ENDED = "_until", "_bucket", "_ended"


class StoredHistory:
    """Every version of a key, with the sequence at which the next one began.

    Versions lie in partitions of a hash of the key and the period in which they ended (none: they
    are open). A row at sequence s changes versions that ended later than s, or not at all; whatever
    ended before lies in other partitions, which a batch neither reads nor writes. Deletes are kept
    as versions that readers do not see, so that a row that comes late, before or after one, still
    finds its place.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: Sequence[str], sequence: str,
        *, buckets: int = 16, days: int = 30, period: int = 1_000_000, piece_rows: int = 1_000_000,
    ):
        """A partition spans ``days`` of a sequence of dates or times, ``period`` numbers of another one."""
        self.spark, self.path, self.keys, self.sequence = spark, path.rstrip("/"), list(keys), sequence
        self.buckets, self.days, self.period, self.piece_rows = buckets, days, period, piece_rows
        self._folder = Folder(spark, self.path)

    def applied(self) -> int:
        notes = self._folder.names("notes")
        return int(notes[-1].partition(".")[0]) if notes else -1

    def _note(self) -> dict:
        notes = self._folder.names("notes")
        return json.loads(self._folder.read(f"notes/{notes[-1]}")) if notes else {"meta": None, "schema": None}

    def meta(self) -> dict | None:
        return self._note()["meta"]

    def _period(self, value: Column, kind: T.DataType) -> Column:
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return F.floor(F.unix_date(F.to_date(value)) / self.days).cast("bigint")
        if isinstance(kind, T.NumericType):
            return F.floor(value / F.lit(self.period)).cast("bigint")
        return F.lit(None).cast("bigint")  # other kinds have no periods: all versions of a bucket lie together

    def stored(self) -> DataFrame:
        """All versions there are, deletes included."""
        schema = self._note()["schema"]
        if schema is None:
            raise ValueError(f"{self.path} has no version yet")
        return self.spark.read.schema(T.StructType.fromJson(schema)).parquet(f"{self.path}/versions")

    def reach(self, batch: DataFrame) -> DataFrame:
        """The versions in partitions that the batch can touch: a filter on partition columns alone."""
        kind = batch.schema[self.sequence].dataType
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        said = batch.agg(F.min(self._period(F.col(self.sequence), kind)).alias("low"), F.collect_set(bucket).alias("buckets")).first()
        found = self.stored().filter(F.col(BUCKET).isin(said["buckets"]))
        if said["low"] is None:
            return found
        return found.filter(F.col(ENDED).isNull() | (F.col(ENDED) >= F.lit(said["low"])))

    def _placed(self, rows: DataFrame) -> DataFrame:
        kind = rows.schema[self.sequence].dataType
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        return rows.withColumns({BUCKET: bucket, ENDED: self._period(F.col(UNTIL), kind)})

    def splice(self, changes: DataFrame, number: int, delete_when: str | Column | None = None, meta: dict | None = None) -> int:
        """Apply a batch, once; rows with a NULL key or sequence are left out.

        The versions of its keys within reach are chained anew with the rows of the batch, and only
        partitions in which a version came or went are written. Their rows are written aside first: if
        the job ends while they are laid out in place, the next attempt lays them out again.
        """
        if self.applied() >= number:
            return number
        aside, note = f"pending/batch={number}", self._note() | {"meta": meta}
        if not self._folder.exists(f"{aside}/_SUCCESS"):
            self._prepare(changes, delete_when).write.mode("overwrite").parquet(f"{self.path}/{aside}")
        ready = self.spark.read.parquet(f"{self.path}/{aside}")
        if not ready.isEmpty():
            place = [BUCKET, ENDED]
            ready = ready.select(*[c for c in ready.columns if c not in place], *place)
            note["schema"] = ready.schema.jsonValue()
            # A partition comes from as few tasks as its size allows: files follow the partitions, not partitions times tasks.
            laid = ready.hint("rebalance", *map(F.col, place))
            laid.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*place).parquet(f"{self.path}/versions")
        self._folder.publish(f"notes/{number:010d}.json", json.dumps(note))
        self._folder.remove(aside)
        return number

    def _prepare(self, changes: DataFrame, delete_when: str | Column | None) -> DataFrame:
        """All rows of the partitions that a batch changes, as they will be."""
        here = [*self.keys, self.sequence]
        rows = newest_per_sequence(mark_deletes(changes.filter(all_present(here)), delete_when), self.keys, self.sequence)
        rows = self._aside(rows, "batch")
        if self._note()["schema"] is None:
            return self._placed(self._chained(rows))
        reach = self.reach(rows)
        mine = reach.join(rows.select(*self.keys).distinct(), self.keys, "left_semi")
        both = mine.drop(UNTIL, BUCKET, ENDED).unionByName(rows, allowMissingColumns=True)
        new = self._aside(self._placed(self._chained(newest_per_sequence(both, self.keys, self.sequence))), "spliced")
        place = [BUCKET, ENDED]
        # A partition changes if a version of the touched keys lies in it before or after, but not alike, or may hold other content.
        marks = [*here, UNTIL, *place]
        before, after = mine.select(*marks), new.select(*marks)
        replaced = rows.select(*here).join(mine.select(*here, *place), here).select(BUCKET, ENDED)
        balance = before.withColumn("_side", F.lit(1)).unionByName(after.withColumn("_side", F.lit(-1))).groupBy(*marks).agg(F.sum("_side").alias("_side"))
        touched = balance.filter("_side <> 0").select(BUCKET, ENDED).unionByName(replaced).distinct()
        others = reach.join(rows.select(*self.keys).distinct(), self.keys, "left_anti")
        everything = others.unionByName(new, allowMissingColumns=True)
        touched = touched.select(F.col(BUCKET).alias("_b"), F.col(ENDED).alias("_e"))
        same = (F.col(BUCKET) == F.col("_b")) & F.col(ENDED).eqNullSafe(F.col("_e"))
        return everything.join(touched, same, "left_semi")

    def _aside(self, rows: DataFrame, label: str) -> DataFrame:
        """What is used several times, written once; the next batch overwrites it."""
        path = f"{self.path}/work/{label}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _chained(self, rows: DataFrame) -> DataFrame:
        return chained(rows, self.keys, self.sequence, self.piece_rows).withColumn(UNTIL, F.col("_next.v")).drop("_next")

    def read(self, valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
        """Every version, with the range in which it held; open ones have a NULL end."""
        rows = self.stored().filter(~F.col(DELETED)).drop(DELETED, BUCKET, ENDED)
        return rows.withColumn(valid_from, F.col(self.sequence)).withColumn(valid_to, F.col(UNTIL)).drop(UNTIL)
