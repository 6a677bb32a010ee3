"""A table read as a stream by its cursor column: the offset is the cursor, kept by Spark's own checkpoint."""

from __future__ import annotations

import datetime
import decimal
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

FORMAT = "cursor_table"
#: Row groups are read together up to so many bytes, as the footers state them.
TASK_BYTES = 128 << 20


def encode(value) -> dict:
    """A cursor value as an offset: text and kind, so that it comes back as what it was."""
    if value is None:
        return {"kind": "none", "text": ""}
    if isinstance(value, bytes):
        return {"kind": "bytes", "text": value.hex()}
    if isinstance(value, (datetime.datetime, datetime.date)):
        return {"kind": type(value).__name__, "text": value.isoformat()}
    return {"kind": type(value).__name__, "text": str(value)}


def decode(offset: dict):
    kinds = {
        "bytes": bytes.fromhex, "datetime": datetime.datetime.fromisoformat, "date": datetime.date.fromisoformat,
        "Decimal": decimal.Decimal, "int": int, "float": float, "str": str,
    }
    return None if offset["kind"] == "none" else kinds[offset["kind"]](offset["text"])


@dataclass(frozen=True)
class _Group:
    """What the footer says of one row group."""

    number: int
    n_bytes: int
    least: object
    most: object
    nulls: bool


class _Part(InputPartition):
    def __init__(self, path: str, groups: list[int], low: dict, high: dict):
        super().__init__((path, groups, low, high))


class CursorReader(DataSourceStreamReader):
    """Rows with a cursor past the start offset, up to the end offset.

    A trigger ends at the greatest cursor that the files have when it begins. Which row groups hold
    rows between two offsets is known from their footers, and only these are opened. Rows without
    a cursor come with the first trigger, as with a first pull, and never after. Files must not change
    once they are there; their footers are read once in the life of a query.
    """

    def __init__(self, path: str, cursor: str):
        self.path, self.cursor = path, cursor
        self._known: dict[str, list[_Group]] = {}

    def _system(self) -> tuple[pa.fs.FileSystem, str]:
        return pa.fs.FileSystem.from_uri(self.path)

    def _files(self) -> list[str]:
        system, root = self._system()
        one = system.get_file_info(root)
        if one.type == pa.fs.FileType.File:
            return [root]
        found = system.get_file_info(pa.fs.FileSelector(root, recursive=True, allow_not_found=True))
        inside = [(i.path, i.path[len(root) :].strip("/").split("/")) for i in found if i.type == pa.fs.FileType.File]
        # Names with a leading mark are notes of writers, or files that are still being written.
        return sorted(path for path, names in inside if not any(n.startswith(("_", ".")) for n in names))

    def _groups(self, path: str) -> list[_Group]:
        if path in self._known:
            return self._known[path]
        system, _ = self._system()
        out = []
        with system.open_input_file(path) as stream:
            file = pq.ParquetFile(stream)
            for number in range(file.metadata.num_row_groups):
                group = file.metadata.row_group(number)
                chunk = next(c for c in map(group.column, range(group.num_columns)) if c.path_in_schema == self.cursor)
                stats = chunk.statistics
                if stats is not None and stats.has_min_max and stats.has_null_count:
                    least, most, nulls = stats.min, stats.max, stats.null_count > 0
                else:  # a writer that leaves no statistics: the column itself
                    values = file.read_row_group(number, columns=[self.cursor]).column(0)
                    ends = pc.min_max(values).as_py()
                    least, most, nulls = ends["min"], ends["max"], values.null_count > 0
                out.append(_Group(number, group.total_byte_size, least, most, nulls))
        self._known[path] = out
        return out

    def initialOffset(self) -> dict:
        return encode(None)

    def latestOffset(self) -> dict:
        seen = [g.most for path in self._files() for g in self._groups(path) if g.most is not None]
        return encode(max(seen, default=None))

    def partitions(self, start: dict, end: dict) -> list[_Part]:
        low, high = decode(start), decode(end)
        parts = []
        for path in self._files():
            held, size = [], 0
            for group in self._groups(path):
                inside = group.most is not None and (low is None or group.most > low) and (high is not None and group.least <= high)
                if not inside and not (low is None and group.nulls):
                    continue
                if held and size + group.n_bytes > TASK_BYTES:
                    parts.append(_Part(path, held, start, end))
                    held, size = [], 0
                held.append(group.number)
                size += group.n_bytes
            if held:
                parts.append(_Part(path, held, start, end))
        return parts

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        path, groups, start, end = partition.value
        low, high = decode(start), decode(end)
        system, _ = self._system()
        with system.open_input_file(path) as stream:
            for batch in pq.ParquetFile(stream).iter_batches(row_groups=groups):
                values = batch.column(batch.schema.names.index(self.cursor))
                wanted = pc.less_equal(values, pa.scalar(high, values.type)) if high is not None else pa.nulls(len(batch), pa.bool_())
                if low is not None:
                    wanted = pc.and_(wanted, pc.greater(values, pa.scalar(low, values.type)))
                rows = batch.filter(pc.fill_null(wanted, low is None))
                if len(rows):
                    yield rows

    def commit(self, end: dict) -> None:
        """Nothing to release: the source keeps its rows."""


class CursorTable(DataSource):
    """``spark.readStream.format("cursor_table")`` with the options ``path`` and ``cursor``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamReader(self, schema: StructType) -> CursorReader:
        return CursorReader(self.options["path"], self.options["cursor"])


def stream_by_cursor(spark: SparkSession, path: str, cursor: str) -> DataFrame:
    """New rows of a Parquet table that others append to, in the order of a column that only grows.

    Nothing is stored but Spark's checkpoint: a query that starts again goes on where the last
    finished batch ended, and a batch that did not finish has the same two offsets again.
    """
    # The process that asks for offsets loads no package that was shipped, so the classes travel whole.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(CursorTable)
    schema = spark.read.parquet(path).schema
    return spark.readStream.format(FORMAT).schema(schema).option("path", path).option("cursor", cursor).load()
