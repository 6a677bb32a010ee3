"""Ingest relational tables: cursor pulls and change feeds into keyed tables or histories."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.operators.changes import DELETED, append_only, hard_deleted, mark_deletes, missing_keys
from sluiceway.sources.relational import (
    TableSpec,
    pull,
    stored_watermark,
    watermark_column,
)
from sluiceway.storage import Folder
from sluiceway.streaming.history_table import StoredHistory
from sluiceway.streaming.keyed_table import KeyedTable

#: The run that brought a row, where that is part of it.
PULLED = "_pulled_at"
#: The partitions of staged runs.
DAY, RUN = "_staged_day", "_staged_run"


class ResnapshotNeeded(RuntimeError):
    """The changes asked for are older than what is staged."""


def _today() -> datetime.date:
    return datetime.datetime.now(datetime.timezone.utc).date()


class RelationalTarget:
    """What one source table is ingested into.

    Pulled rows are staged first: the source is read once, and the watermark is taken from the
    rows that were staged. The watermark is stored with the version it belongs to.
    """

    def __init__(self, spark: SparkSession, base: str, spec: TableSpec, buckets: int | None = None):
        self.spark, self.spec = spark, spec
        self.base = f"{base}/{spec.name}"
        self._folder = Folder(spark, self.base)
        keys = list(spec.primary_keys)
        if spec.scd_type == 2:
            self.history = StoredHistory(spark, f"{self.base}/history", keys, self.sequence, buckets=buckets or 16)
        else:
            self.table = KeyedTable(spark, f"{self.base}/state", keys, [self.sequence], buckets=buckets)

    @property
    def sequence(self) -> str:
        return self.spec.cursor or PULLED

    def watermark(self) -> dict | None:
        """Where the next pull begins: the text of the cursor and its type."""
        if self.spec.scd_type == "append":
            return self._appended_watermark()
        return ((self.history if self.spec.scd_type == 2 else self.table).meta() or {}).get("watermark")

    def _finished(self) -> dict[int, str]:
        """Staged runs that are whole, with their paths."""
        found = self._folder.matching(f"staged/{DAY}=*/{RUN}=*/_SUCCESS")
        return {int(n.split("/")[-2].partition("=")[2]): f"{self.base}/{n.rpartition('/')[0]}" for n in found}

    def _read_staged(self, paths: Sequence[str]) -> DataFrame:
        return self.spark.read.option("mergeSchema", "true").option("basePath", f"{self.base}/staged").parquet(*paths).drop(DAY, RUN)

    def _appended_runs(self) -> list[int]:
        return sorted(int(n.partition("=")[2]) for n in self._folder.names("appended") if n.startswith(f"{PULLED}="))

    def _appended(self) -> DataFrame:
        rows = self.spark.read.option("mergeSchema", "true").parquet(f"{self.base}/appended")
        return rows.withColumn(PULLED, F.col(PULLED).cast("bigint"))

    def _appended_watermark(self, run: int | None = None) -> dict | None:
        """The greatest cursor of the rows of earlier runs, deletes among them: one column is read."""
        if self.spec.cursor is None:
            return None
        paths = [path for r, path in self._finished().items() if run is None or r < run]
        found = ([self._read_staged(paths)] if paths else []) + ([self._appended()] if self._appended_runs() else [])
        if not found:
            return None
        rows = found[0].select(self.spec.cursor)
        for more in found[1:]:
            rows = rows.unionAll(more.select(self.spec.cursor))
        return stored_watermark(rows, self.spec.cursor)

    def done(self, run: int) -> bool:
        if self.spec.scd_type == "append":
            return any(r >= run for r in self._appended_runs())
        if self.spec.scd_type == 2:
            return self.history.applied() >= run
        return self.table.applied(self.spec.name) >= run

    def _staged_path(self, run: int, day: datetime.date | None = None) -> str:
        """Where a run is staged: where it is already, else below its day."""
        there = self._folder.matching(f"staged/{DAY}=*/{RUN}={run}")
        return f"{self.base}/{there[-1]}" if there else f"{self.base}/staged/{DAY}={day or _today()}/{RUN}={run}"

    def staged(self, run: int) -> DataFrame:
        return self.spark.read.parquet(self._staged_path(run))

    def expire(self, day: datetime.date) -> int:
        """Drop staged runs older than what the spec keeps; returns how many days went."""
        oldest = day - datetime.timedelta(days=self.spec.retention_days)
        old = [n for n in self._folder.names("staged") if n.startswith(f"{DAY}=") and n.partition("=")[2] < oldest.isoformat()]
        for name in old:
            self._folder.remove(f"staged/{name}")
        return len(old)

    def staged_since(self, day: datetime.date, as_of: datetime.date | None = None) -> DataFrame:
        """What was pulled from a day on, to be applied anew; beyond the retention only a new snapshot helps."""
        oldest = (as_of or _today()) - datetime.timedelta(days=self.spec.retention_days)
        if day < oldest:
            raise ResnapshotNeeded(f"{self.spec.name}: changes before {oldest} are no longer staged")
        return self._read_staged([p for p in self._finished().values() if p.split("/")[-2].partition("=")[2] >= day.isoformat()])

    def left_out(self, run: int) -> int:
        """Rows of a staged run that no state or history can hold, since a key or the order is NULL."""
        if self.spec.scd_type == "append":
            return 0
        keys = [*self.spec.primary_keys, *([self.sequence] if self.spec.scd_type == 2 else [])]
        return missing_keys(self.staged(run), keys).count()

    def apply(self, changes: DataFrame, run: int, delete_when: str | None = None, meta: dict | None = None) -> int:
        if self.spec.scd_type == 2:
            return self.history.splice(changes, run, delete_when or self.spec.delete_when, meta)
        return self.table.upsert(
            changes, self.spec.name, run, delete_when or self.spec.delete_when, meta=meta
        )

    def run_pull(self, source: DataFrame, run: int, key_snapshot: DataFrame | None = None, day: datetime.date | None = None) -> int | None:
        """One scheduled run of a day (today): rows past the watermark, or the whole table without a cursor.

        Staged runs older than the spec's retention are dropped at its end.

        A pull does not see rows that are gone. ``key_snapshot`` names the keys that the source has
        now; rows of current state with another key are deleted in the same run.
        """
        if key_snapshot is not None and (self.spec.scd_type != 1 or self.spec.cursor is None):
            raise ValueError("a key snapshot belongs to current state that is pulled by cursor")
        if self.done(run):
            return run if self.spec.scd_type != 1 else self.table.version()
        if self.spec.scd_type == "append":
            version = self._append(source, run, day)
        elif self.spec.cursor is None:
            version = self._reload(source, run, day)
        else:
            version = self._pull(source, run, key_snapshot, day)
        self.expire(day or _today())
        return version

    def _pull(self, source: DataFrame, run: int, key_snapshot: DataFrame | None, day: datetime.date | None) -> int:
        path = self._staged_path(run, day)
        before = self.watermark()
        pull(source, self.spec.cursor, watermark_column(before)).write.mode("overwrite").parquet(path)
        staged = self.spark.read.parquet(path)
        mark = stored_watermark(staged, self.spec.cursor, before)
        changes = staged
        if key_snapshot is not None and self.table.version() is not None:
            gone = hard_deleted(self.table.read(), key_snapshot, self.spec.primary_keys)
            # A key that comes back later has a greater cursor, one that was pulled just now stays.
            gone = gone.join(staged.select(*self.spec.primary_keys), list(self.spec.primary_keys), "left_anti")
            # A delete has the cursor of the row that it removes; the stamp makes it the newer one.
            marked = gone.withColumn(DELETED, F.lit(True)).withColumn("_ingested_at", F.current_timestamp())
            own = "_ingested_at" in staged.columns or self.table.meta().get("own_stamp", False)
            changes = mark_deletes(staged, self.spec.delete_when).unionByName(marked, allowMissingColumns=True)
            meta = {"watermark": mark, "own_stamp": own, "stamped": True}
            return self.table.upsert(changes, self.spec.name, run, F.col(DELETED), meta=meta)
        return self.apply(changes, run, meta={"watermark": mark})

    def _append(self, source: DataFrame, run: int, day: datetime.date | None) -> int:
        """Every pulled row as it came: no key, no reduction, nothing lost to equal or NULL cursors.

        A run is a partition, and a run that is made again overwrites its own.
        """
        runs = self._appended_runs()
        for r in sorted(self._finished()):
            if (not runs or r > runs[-1]) and r < run:  # staged, but the job ended before it was appended
                self._keep(r)
        rows = source.withColumn(PULLED, F.lit(run).cast("bigint"))
        rows = pull(rows, self.spec.cursor, watermark_column(self._appended_watermark(run)))
        rows.write.mode("overwrite").parquet(self._staged_path(run, day))
        self._keep(run)
        return run

    def _keep(self, run: int) -> None:
        kept = append_only(self.staged(run), self.spec.delete_when)
        kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PULLED).parquet(f"{self.base}/appended")

    def _reload(self, source: DataFrame, run: int, day: datetime.date | None) -> int:
        """Without a cursor every run reads the whole table.

        For current state the snapshot replaces what was there, so keys that are gone go too.
        """
        path, stamp = self._staged_path(run, day), F.lit(run).cast("bigint")
        source.withColumn(PULLED, stamp).write.mode("overwrite").parquet(path)
        staged = self.spark.read.parquet(path)
        if self.spec.scd_type != 1 or self.table.version() is None:
            return self.apply(staged, run)
        gone = hard_deleted(self.table.read(), staged, self.spec.primary_keys)
        marked = gone.withColumn(PULLED, stamp).withColumn(DELETED, F.lit(True))
        return self.table.upsert(
            staged.withColumn(DELETED, F.lit(False)).unionByName(marked, allowMissingColumns=True),
            self.spec.name, run,
        )

    def read(self) -> DataFrame:
        """Current state, history or the appended rows, as the spec says."""
        if self.spec.scd_type == 1:
            meta = self.table.meta()
            return self.table.read().drop(*["_ingested_at"] * (meta.get("stamped", False) and not meta["own_stamp"]))
        if self.spec.scd_type == 2:
            return self.history.read()
        if not self._appended_runs():
            raise ValueError(f"{self.base} has no run yet")
        return self._appended()


def ingest_tables(
    spark: SparkSession,
    base: str,
    specs: Sequence[TableSpec],
    source: Callable[[str], DataFrame],
    run: int,
    buckets: int | None = None,
    parallel: int = 4,
) -> dict[str, RelationalTarget]:
    """One run over several tables, each with its own keys, cursor and watermark.

    Tables do not depend on each other, so a few are ingested at a time.
    """

    def ingest(spec: TableSpec) -> RelationalTarget:
        target = RelationalTarget(spark, base, spec, buckets)
        target.run_pull(source(spec.name), run)
        return target

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return {target.spec.name: target for target in pool.map(ingest, specs)}
