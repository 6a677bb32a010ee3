"""Dropped files: discovery, evolving schema, rescued values, lineage."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.storage import Folder

RESCUED = "_rescued_data"
CORRUPT = "_corrupt_record"

_LISTING = "path string, modificationTime timestamp, length bigint, content binary"


def discover(
    spark: SparkSession,
    path: str,
    max_files: int = 1000,
    pattern: str | None = None,
) -> DataFrame:
    """A stream of new files below a folder, each exactly once; contents are not read.

    ``max_files`` bounds one micro-batch and so the file list the driver holds; a trigger goes on
    with further batches until every file is in. Files count as new whatever their modification
    time: the age limit that a file stream has of its own is set beyond any file, since it would
    leave out old files that arrive late without a trace.
    """
    reader = (
        spark.readStream.format("binaryFile")
        .schema(_LISTING)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", "36500d")
    )
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "modificationTime", "length")


def _exactly(path: str) -> str:
    """The path as a pattern that matches only itself."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


class SchemaRegistry:
    """The columns a feed has had so far. Columns are added, never retyped."""

    def __init__(self, spark: SparkSession, path: str):
        self._folder = Folder(spark, path)

    def current(self) -> T.StructType:
        names = self._folder.names()
        return T.StructType.fromJson(json.loads(self._folder.read(names[-1]))) if names else T.StructType([])

    def evolve(self, found: T.StructType) -> T.StructType:
        for attempt in range(10):
            known = self.current()
            names = {f.name.lower() for f in known}
            new = [T.StructField(f.name, _storable(f.dataType), True) for f in found if f.name.lower() not in names]
            if not new:
                return known
            grown = T.StructType(known.fields + new)
            try:
                self._folder.publish(f"{len(self._folder.names()):010d}.json", grown.json())
                return grown
            except FileExistsError:  # another writer was first: add to what it published
                if attempt == 9:
                    raise


def _storable(kind: T.DataType) -> T.DataType:
    """A column of which only NULLs were seen is kept as text."""
    return T.StringType() if isinstance(kind, T.NullType) else kind


class _Group:
    """Files that one scan can read, and how to read them."""

    def __init__(self, paths: list[str], schema: T.StructType, rows: DataFrame):
        self.paths, self.schema, self.rows = paths, schema, rows


def _fits(a: T.StructType, b: T.StructType) -> bool:
    types = {f.name.lower(): f.dataType for f in a}
    return all(types.get(f.name.lower(), f.dataType) == f.dataType for f in b)


def _parquet_schemas(spark: SparkSession, paths: list[str], options: dict) -> list[tuple[list[str], T.StructType]]:
    """Files with schemas that merge. One pass over the footers, unless types disagree: then
    the list is halved until they agree."""
    try:
        merged = spark.read.options(**options).option("mergeSchema", "true").parquet(*paths).schema
        return [(paths, merged)]
    except (PySparkException, Py4JJavaError) as problem:
        if len(paths) == 1 or "CANNOT_MERGE" not in str(problem):
            raise
        middle = len(paths) // 2
        groups: list[tuple[list[str], T.StructType]] = []
        for part in (paths[:middle], paths[middle:]):
            for members, schema in _parquet_schemas(spark, part, options):
                for position, (others, known) in enumerate(groups):
                    if _fits(known, schema):
                        names = {f.name.lower() for f in known}
                        extra = [f for f in schema if f.name.lower() not in names]
                        groups[position] = (others + members, T.StructType(known.fields + extra))
                        break
                else:
                    groups.append((members, schema))
        return groups


def _parquet_groups(spark, paths, known, options) -> list[_Group]:
    return [
        _Group(members, schema, spark.read.options(**options).schema(schema).parquet(*members))
        for members, schema in _parquet_schemas(spark, paths, options)
    ]


def _as_text(schema: T.StructType) -> T.StructType:
    fields = [T.StructField(f.name, T.StringType(), True) for f in schema if f.name != CORRUPT]
    return T.StructType([*fields, T.StructField(CORRUPT, T.StringType(), True)])


def _json_groups(spark, paths, known, options) -> list[_Group]:
    inferred = spark.read.options(**options).json(paths).schema
    named = T.StructType([f for f in inferred if f.name != CORRUPT])
    if not named.fields:  # not one line is an object: there is nothing but what is broken
        lines = spark.read.text(paths).withColumnRenamed("value", CORRUPT)
        return [_Group(paths, named, lines.filter(F.btrim(CORRUPT) != ""))]
    rows = (
        spark.read.options(**options).schema(_as_text(inferred))
        .option("columnNameOfCorruptRecord", CORRUPT).json(paths)
    )
    return [_Group(paths, named, rows)]


def _csv_groups(spark, paths, known, options) -> list[_Group]:
    """CSV columns go by position, so only files with the same header line are read together."""
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )
    heads = lines.groupBy("file").agg(F.min_by("value", "at").alias("head"))
    by_head: dict[str, list[str]] = {}
    for row in heads.orderBy("file").collect():  # one row per file of the batch
        # Lineage paths are percent-encoded.
        by_head.setdefault(row["head"], []).append(_exactly(unquote(row["file"])))
    names = {f.name.lower() for f in known}
    groups = []
    for members in by_head.values():
        reader = spark.read.options(**options).option("header", "true")
        header = reader.csv(members[0]).schema
        types = header
        if any(f.name.lower() not in names for f in header):
            types = reader.option("inferSchema", "true").csv(members).schema
        rows = (
            spark.read.options(**options).option("header", "true").schema(_as_text(header))
            .option("enforceSchema", "true").option("columnNameOfCorruptRecord", CORRUPT).csv(members)
        )
        groups.append(_Group(members, types, rows))
    return groups


def _avro_groups(spark, paths, known, options) -> list[_Group]:
    try:
        rows = spark.read.format("avro").options(**options).load(paths)
    except AnalysisException as problem:
        raise ValueError("file_format avro needs the spark-avro package on the cluster") from problem
    return [_Group(paths, rows.schema, rows)]


_READERS = {"parquet": _parquet_groups, "json": _json_groups, "csv": _csv_groups, "avro": _avro_groups}


def _castable(spark: SparkSession, source: T.DataType, target: T.DataType) -> bool:
    if isinstance(source, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return False
    try:
        spark.range(0).select(F.lit(None).cast(source).try_cast(target)).schema
    except AnalysisException:
        return False
    return True


def coerce(df: DataFrame, name: str, target: T.DataType) -> tuple[Column, Column]:
    """The column in its registered type, and the text of values that do not fit (else NULL).

    A cast that would change the value counts as not fitting.
    """
    column, source = F.col(f"`{name}`"), df.schema[name].dataType
    nothing = F.lit(None).cast("string")
    if source == target:
        return column, nothing
    nested = (T.StructType, T.ArrayType, T.MapType)
    if isinstance(source, T.StringType) and isinstance(target, nested):
        value = F.from_json(column, target.simpleString())
        return value, F.when(column.isNotNull() & value.isNull(), column)
    text = F.to_json(column) if isinstance(source, (*nested, T.VariantType)) else column.cast("string")
    if isinstance(target, T.StringType):
        return text, nothing
    if not _castable(df.sparkSession, source, target):
        return F.lit(None).cast(target), text
    value = column.try_cast(target)
    fits = value.isNotNull()
    if not isinstance(source, T.StringType):
        fits = fits & value.try_cast(source).eqNullSafe(column)
    return F.when(fits, value), F.when(column.isNotNull() & ~fits, text)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows in the registered columns; what does not fit goes to ``_rescued_data`` as JSON."""
    present = {c.lower(): c for c in df.columns}
    columns, leftovers = [], []
    for target in schema:
        name = present.get(target.name.lower())
        if name is None:
            columns.append(F.lit(None).cast(target.dataType).alias(target.name))
            continue
        value, left = coerce(df, name, target.dataType)
        columns.append(value.alias(target.name))
        if df.schema[name].dataType != target.dataType:
            leftovers.append(left.alias(target.name))
    if CORRUPT in df.columns:
        leftovers.append(F.col(CORRUPT).alias(CORRUPT))
    if leftovers:
        rescued = F.to_json(F.struct(*leftovers))
        rescued = F.when(rescued != "{}", rescued)
    else:
        rescued = F.lit(None).cast("string")
    lineage = [c for c in ("source_file", "source_file_size", "source_file_modified_at") if c in df.columns]
    return df.select(*columns, rescued.alias(RESCUED), *lineage)


def read_files(
    spark: SparkSession,
    paths: Sequence[str],
    file_format: str,
    registry: SchemaRegistry,
    options: dict | None = None,
) -> DataFrame:
    """New files in the registered columns, with rescued values and lineage."""
    options = {k: str(v) for k, v in (options or {}).items() if k != "pathGlobFilter"}
    exact = [_exactly(path) for path in paths]
    groups = _READERS[file_format](spark, exact, registry.current(), options)
    for group in groups:
        schema = registry.evolve(group.schema)
    frames = []
    for group in groups:
        rows = group.rows.select(
            "*",
            F.col("_metadata.file_path").alias("source_file"),
            F.col("_metadata.file_size").alias("source_file_size"),
            F.col("_metadata.file_modification_time").alias("source_file_modified_at"),
        )
        frames.append(conform(rows, schema))
    combined = frames[0]
    for frame in frames[1:]:
        combined = combined.unionByName(frame)
    return combined
