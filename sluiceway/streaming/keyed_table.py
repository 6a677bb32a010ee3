"""A keyed current-state table on plain Parquet.

Parquet has no MERGE. Each batch is reduced to one row per key and appended as a delta of the
hash buckets it touches; a bucket with too many deltas is folded into one file set. A small commit
file, written last, names what is live. The cost of a batch follows the batch, not the table;
``max_deltas=0`` folds at once instead, for tables that are read far more often than written.
Where a lake format with MERGE is at hand, ``upsert`` is the one call to replace.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.operators.changes import DELETED, latest_per_key, mark_deletes, table_changes
from sluiceway.storage import Folder

BUCKET = "_bucket"


class KeyedTable:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        sequence_by: Sequence[str],
        buckets: int | None = None,
        max_deltas: int = 8,
        sort_by: Sequence[str] = (),
    ):
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.sequence_by = list(keys), list(sequence_by)
        self.max_deltas, self.sort_by = max_deltas, list(sort_by)
        self._folder = Folder(spark, self.path)
        latest = self.version()
        made = self.commit(latest) if latest is not None else None
        self.buckets = buckets or (made["buckets"] if made else self._shuffle_partitions())
        if made:
            self._check(made)

    def _shuffle_partitions(self) -> int:
        return int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _check(self, commit: dict) -> None:
        mine = (self.keys, self.sequence_by, self.buckets)
        theirs = (commit["keys"], commit["sequence_by"], commit["buckets"])
        if mine != theirs:
            raise ValueError(f"{self.path} was made with keys, sequence and buckets {theirs}, not {mine}")

    # -- commits -----------------------------------------------------------------------------

    def version(self) -> int | None:
        """The newest version, or None before the first commit."""
        found = [int(n.split(".")[0]) for n in self._folder.names("commits") if n.endswith(".json")]
        return max(found, default=None)

    def commit(self, version: int) -> dict:
        return json.loads(self._folder.read(f"commits/{version:010d}.json"))

    def has(self, version: int) -> bool:
        """Whether a version can still be read."""
        return self._folder.exists(f"commits/{version:010d}.json")

    def meta(self, version: int | None = None) -> dict:
        """What the writer stored with a version, such as a watermark."""
        version = self.version() if version is None else version
        return {} if version is None else self.commit(version)["meta"]

    def applied(self, query_id: str) -> int:
        """The last batch of a query in this table, or -1."""
        version = self.version()
        return -1 if version is None else self.commit(version)["applied"].get(query_id, -1)

    def schema(self, version: int | None = None) -> T.StructType:
        version = self.version() if version is None else version
        return T.StructType.fromJson(self.commit(version)["schema"])

    # -- reading -----------------------------------------------------------------------------

    def _scan(self, commit: dict, places: Sequence[tuple[str, str]]) -> DataFrame:
        """The rows of some (commit, bucket) folders, as they were written."""
        schema = T.StructType.fromJson(commit["schema"])
        if not places:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/data/commit={c}/{BUCKET}={b}" for c, b in places]
        return self.spark.read.schema(schema).parquet(*paths)

    def _clean(self, commit: dict, buckets: Sequence[str]) -> list[tuple[str, str]]:
        return [(commit["live"][b][0], b) for b in buckets if len(commit["live"][b]) == 1]

    def _base(self, commit: dict, buckets: Sequence[str]) -> list[tuple[str, str]]:
        return [(commit["live"][b][0], b) for b in buckets if len(commit["live"][b]) > 1]

    def _deltas(self, commit: dict, buckets: Sequence[str]) -> list[tuple[str, str]]:
        return [(c, b) for b in buckets for c in commit["live"][b][1:]]

    def _newest(self, rows: DataFrame) -> DataFrame:
        return latest_per_key(rows, self.keys, self.sequence_by)

    def _mixed(self, commit: dict, buckets: Sequence[str]) -> DataFrame:
        """Buckets with deltas, one row per key: reduced before the shuffle, whatever their size."""
        return self._newest(self._scan(commit, self._base(commit, buckets) + self._deltas(commit, buckets)))

    def _load(self, commit: dict, buckets: Sequence[str]) -> DataFrame:
        """The rows of some buckets, one per key, deletes included."""
        clean = self._scan(commit, self._clean(commit, buckets))
        if not self._deltas(commit, buckets):
            return clean
        mixed = self._mixed(commit, buckets)
        return clean.unionByName(mixed) if self._clean(commit, buckets) else mixed

    def read(self, version: int | None = None, with_deleted: bool = False) -> DataFrame:
        version = self.version() if version is None else version
        if version is None:
            raise ValueError(f"{self.path} has no version yet")
        commit = self.commit(version)
        rows = self._load(commit, sorted(commit["live"]))
        return rows if with_deleted else rows.filter(~F.col(DELETED)).drop(DELETED)

    def changes(self, before: int | None, after: int | None = None, ignore: Sequence[str] = ()) -> DataFrame:
        """Row-level changes between two versions.

        Only keys in the deltas of the versions between can differ, so both states are cut down to
        those keys in the scan, before anything is reduced or joined.
        """
        last = self.version() if after is None else after
        new = self.commit(last)
        first = -1 if before is None else before
        between = [self.commit(v) for v in range(first + 1, last + 1)]
        written = [(c["delta"], b) for c in between for b in c["written"]]
        touched = sorted({b for _, b in written})
        keys = self._scan(new, written).select(*self.keys)

        def state(commit: dict) -> DataFrame:
            live = [b for b in touched if b in commit["live"]]
            places = self._clean(commit, live) + self._base(commit, live) + self._deltas(commit, live)
            rows = self._newest(self._scan(commit, places).join(keys, self.keys, "left_semi"))
            return rows.filter(~F.col(DELETED)).drop(DELETED)

        old = {**new, "live": {}} if before is None else self.commit(before)
        return table_changes(state(old), state(new), self.keys, ignore)

    # -- writing -----------------------------------------------------------------------------

    def upsert(
        self,
        changes: DataFrame,
        query_id: str,
        batch_id: int,
        delete_when: str | Column | None = None,
        meta: dict | None = None,
        before_commit: Callable[[], None] | None = None,
    ) -> int:
        """Apply a batch once: the newest row per key wins, whenever it arrives.

        A batch that is already in the table changes nothing. Deletes stay as marked rows, so that
        an older change that comes late cannot bring a key back. ``before_commit`` runs when the
        rows are written but not yet visible, and may raise.
        """
        latest = self.version()
        last = self.commit(latest) if latest is not None else None
        if last and last["applied"].get(query_id, -1) >= batch_id:
            return latest
        version = 0 if latest is None else latest + 1
        rows = latest_per_key(mark_deletes(changes, delete_when), self.keys, self.sequence_by)
        schema = _merged(T.StructType.fromJson(last["schema"]) if last else None, rows.schema)
        live = {b: list(c) for b, c in last["live"].items()} if last else {}
        # Another attempt at this version must not touch these files: only the commit names them.
        delta = f"{version}-{uuid.uuid4().hex[:12]}"
        written = self._write(rows, delta)
        for bucket in written:
            live.setdefault(bucket, []).append(delta)
        commit = {
            "version": version,
            "keys": self.keys,
            "sequence_by": self.sequence_by,
            "buckets": self.buckets,
            "schema": json.loads(schema.json()),
            "live": live,
            "written": written,
            "delta": delta,
            "applied": {**(last["applied"] if last else {}), query_id: batch_id},
            "meta": {**(last["meta"] if last else {}), **(meta or {})},
        }
        if before_commit:
            before_commit()
        self._fold(commit, [b for b in live if len(live[b]) > self.max_deltas + 1])
        self._folder.publish(f"commits/{version:010d}.json", json.dumps(commit))
        return version

    def _write(self, rows: DataFrame, commit: str) -> list[str]:
        """Write rows that were just reduced per key, by bucket, and name the buckets written.

        The bucket is the hash by which the reducing shuffle placed the rows. Where the number of
        partitions is a multiple of the buckets, or the other way round, no bucket is spread over
        more tasks than it needs, and nothing has to move again. Otherwise rows are brought
        together by bucket, with large buckets split and small ones joined. The sort keeps
        clustered columns together inside each file.
        """
        bucket = F.pmod(F.hash(*self.keys), F.lit(self.buckets)).cast("int")
        placed = rows.withColumn(BUCKET, bucket)
        partitions = self._shuffle_partitions()
        if partitions % self.buckets and self.buckets % partitions:
            placed = placed.hint("rebalance", BUCKET)
        (
            placed.sortWithinPartitions(BUCKET, *(self.sort_by or self.keys))
            .write.mode("overwrite")
            .partitionBy(BUCKET)
            .parquet(f"{self.path}/data/commit={commit}")
        )
        found = self._folder.names(f"data/commit={commit}")
        return [n.split("=")[1] for n in found if n.startswith(f"{BUCKET}=")]

    def _fold(self, commit: dict, buckets: Sequence[str]) -> None:
        """Give each bucket one file set. All rows are reduced, which also brings files together."""
        if not buckets:
            return
        name = f"{commit['version']}f-{uuid.uuid4().hex[:12]}"
        places = self._base(commit, buckets) + self._deltas(commit, buckets)
        for bucket in self._write(self._newest(self._scan(commit, places)), name):
            commit["live"][bucket] = [name]

    def compact(self) -> int:
        """Fold every bucket that has deltas."""
        latest = self.version()
        commit = self.commit(latest)
        dirty = [b for b, c in commit["live"].items() if len(c) > 1]
        if not dirty:
            return latest
        commit |= {"version": latest + 1, "written": []}
        self._fold(commit, dirty)
        self._folder.publish(f"commits/{latest + 1:010d}.json", json.dumps(commit))
        return latest + 1

    def expire(self, keep: int) -> list[str]:
        """Forget all but the newest versions and remove files that none of them names."""
        versions = [int(n.split(".")[0]) for n in self._folder.names("commits")]
        kept = versions[-keep:]
        used = {c for v in kept for commits in self.commit(v)["live"].values() for c in commits}
        # The own delta of each kept version but the first tells its changes from the one before.
        used |= {self.commit(v)["delta"] for v in kept[1:]}
        for version in versions[:-keep]:
            self._folder.remove(f"commits/{version:010d}.json")
        # Files of versions still to come belong to a write in progress.
        names = {n: n.split("=")[1] for n in self._folder.names("data")}
        unused = [n for n, c in names.items() if c not in used and int(re.match(r"\d+", c)[0]) <= kept[-1]]
        for name in unused:
            self._folder.remove(f"data/{name}")
        return unused


def _merged(known: T.StructType | None, found: T.StructType) -> T.StructType:
    """Columns are added, never retyped."""
    if known is None:
        return T.StructType([T.StructField(f.name, f.dataType, True) for f in found])
    types = {f.name: f.dataType for f in known}
    for field in found:
        if field.name in types and types[field.name] != field.dataType:
            raise TypeError(
                f"column {field.name} is {types[field.name].simpleString()} in the table "
                f"and {field.dataType.simpleString()} in the batch"
            )
    new = [T.StructField(f.name, f.dataType, True) for f in found if f.name not in types]
    return T.StructType(known.fields + new)
