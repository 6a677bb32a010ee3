"""Small helpers of the training-text operators: stored tables, shared files, connected components."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.session import scratch_path, ship_package
from sluiceway.storage import Folder

#: A word, as every contract here has it; ``bytes.split()`` cuts UTF-8 text into exactly these.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text in one Arrow batch, so that a Python worker's memory does not follow the length of texts.
BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession) -> None:
    """What the operators expect of a session: the package on the workers, Arrow batches of few bytes.

    A batch size that the user has set is left alone.
    """
    ship_package(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class _Made(threading.local):
    """Paths of the tables that this thread has stored, in order."""

    def __init__(self):
        self.paths: list[str] = []


_made = _Made()


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read from there: lineage ends, lost executors don't matter.

    The table stays until ``forget`` removes it, since results are read lazily.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    _made.paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_so_far() -> int:
    """How many tables this thread has stored: where ``forget`` may begin."""
    return len(_made.paths)


def forget(spark: SparkSession, since: int = 0, but_last: int = 0) -> None:
    """Remove tables that this thread stored, from one on, except the latest few. Results that still read them are lost."""
    paths = _made.paths
    for path in paths[since : len(paths) - but_last]:
        folder, _, name = path.rpartition("/")
        Folder(spark, folder).remove(name)
    del paths[since : len(paths) - but_last]


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns under the names used here, so that nothing else can clash."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def raw_bytes(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; null is empty."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def create_file(path: str):
    """A new binary file on any file system pyarrow knows, its folder included."""
    system, place = pyarrow.fs.FileSystem.from_uri(path)
    system.create_dir(place.rpartition("/")[0], recursive=True)
    return system.open_output_stream(place, compression=None)


def open_file(path: str):
    system, place = pyarrow.fs.FileSystem.from_uri(path)
    return system.open_input_file(place)


def read_file(path: str) -> bytes:
    with open_file(path) as file:
        return file.read()


def pieces(texts: list[bytes], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts of about ``limit`` bytes each (one long text makes its own range)."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def packed(numbers: np.ndarray) -> bytes:
    """Numbers of 32 bits, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(numbers, np.int32).tobytes())


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.int32)


class Memo:
    """What was worked out before, in two generations of bounded size: the older one is dropped whole."""

    def __init__(self, limit: int):
        self.limit, self.young, self.old = limit, {}, {}

    def rotate(self) -> None:
        """Between batches only: within one, all that was added stays."""
        if len(self.young) > self.limit:
            self.young, self.old = {}, self.young

    def missing(self, keys) -> list:
        """Keys not known yet, each once; those of the older generation move to the younger."""
        young, old, found = self.young, self.old, {}
        for key in keys:
            if key not in young:
                if key in old:
                    young[key] = old[key]
                else:
                    found[key] = None
        return list(found)


def varied(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices that gather slices of different lengths one after another."""
    ends = np.cumsum(lengths, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if total + (int(starts.max()) if len(starts) else 0) < 1 << 31 else np.int64
    return np.repeat((starts - (ends - lengths)).astype(kind), lengths) + np.arange(total, dtype=kind)


def components(edges: DataFrame, label: str, rounds: int = 100) -> DataFrame:
    """Connected components of edges ``(a, b)``: one row ``(node, component)`` per node, its smallest node.

    Alternating large and small stars: every round is two joins on the node, rows never outnumber
    the edges, and a hub is a skewed join key that adaptive execution splits. Rounds grow with the
    logarithm of the longest path. Each round is a stored table.
    """

    def mark(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    current = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    before = mark(current)
    for _ in range(rounds):
        if not before[0]:
            break
        both = current.unionAll(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large, label)
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        current = stored(small.where("a <> b").distinct(), label)
        after = mark(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionAll(current.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()


Batches = Iterator[pa.RecordBatch]
Mapper = Callable[[Batches], Batches]
