"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import Batches, components, free_name, picked, raw_bytes, stored

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
BITS = 64
#: Fingerprints of a bucket that a task compares at once. Larger buckets are dealt out in pairs of blocks.
BUCKET_ROWS = 4_096


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """A bit is set if it is in more than half of the shingles' hashes; no words give zero."""
    import xxhash

    cut = text.lower().split()  # of bytes: only A-Z change
    if not cut:
        return 0
    digest, joined = xxhash.xxh64_intdigest, b" ".join(cut)
    ends = np.cumsum([len(w) + 1 for w in cut])
    n = max(len(cut) - words + 1, 1)
    starts, stops = [0, *ends[: n - 1].tolist()], (ends[-n:] - 1).tolist()
    hashes = np.fromiter((digest(joined[a:b], seed=SEED) for a, b in zip(starts, stops)), np.uint64, n)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """Rows with a column ``text`` to the same rows with ``fp`` instead; the 64 bits as a signed number."""
    rest = [f for f in docs.schema if f.name != "text"]

    def run(batches: Batches) -> Batches:
        for batch in batches:
            found = np.array([fingerprint(t) for t in raw_bytes(batch.column("text"))], np.uint64)
            columns = [batch.column(f.name) for f in rest]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found.view(np.int64))], names=[*(f.name for f in rest), "fp"])

    return docs.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rest) + ", fp bigint")


def masks(radius: int = RADIUS, seed: int = 1) -> list[int]:
    """Masks of a covering: two numbers that differ in ``radius`` bits or fewer agree under one of them.

    Each bit gets a random vector of ``radius + 1`` bits, and each nonzero vector v gives the mask of
    the bits whose vector has an odd product with v. For any ``radius`` bits some v is orthogonal to
    all their vectors (fewer equations than unknowns), so its mask leaves these bits out.
    """
    draw = random.Random(seed)
    vectors = [draw.randrange(1, 1 << radius + 1) for _ in range(BITS)]
    found = []
    for v in range(1, 1 << radius + 1):
        mask = sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2)
        found.append(mask - (1 << BITS) if mask >> BITS - 1 else mask)
    return found


def _forest(fps: np.ndarray, left: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows of the same run that differ in ``radius`` bits or fewer; no link closes a circle.

    Every two rows of a run are compared, at ever larger distances in the run. ``left`` counts the
    rows of the run that follow.
    """
    root = np.arange(len(fps))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return int(i)

    ends: tuple[list[int], list[int]] = ([], [])
    at, step = np.flatnonzero(left >= 1), 1
    while len(at):
        near = at[np.bitwise_count(fps[at] ^ fps[at + step]) <= radius]
        if len(near):
            while not np.array_equal(root, root[root]):
                root = root[root]
            for i in near[root[near] != root[near + step]].tolist():
                a, b = find(i), find(i + step)
                if a != b:
                    root[max(a, b)] = min(a, b)
                    ends[0].append(i)
                    ends[1].append(i + step)
        step += 1
        at = at[left[at] >= step]
    return fps[np.array(ends[0], np.int64)], fps[np.array(ends[1], np.int64)]


def _compare(keys: tuple[str, ...], radius: int, limit: int | None, batches: Batches) -> Batches:
    """Rows sorted by ``keys`` to links ``(a, b)`` within each run of equal keys.

    Rows of runs above ``limit`` come back with ``a`` null, ``b`` and their first two keys; such a run
    is passed on batch by batch and never held.
    """
    names = ["a", "b", "mask", "bucket"]

    def passed(rows: list[np.ndarray]) -> pa.RecordBatch:
        none = pa.nulls(len(rows[-1]), pa.int64())
        columns = [none, *(pa.array(r.astype(np.int64)) for r in (rows[-1], rows[0], rows[1]))]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def compared(rows: list[np.ndarray], change: np.ndarray) -> Batches:
        run = np.cumsum(change)
        large = np.zeros(len(run), bool) if limit is None else (np.bincount(run) > limit)[run]
        if large.any():
            yield passed([r[large] for r in rows])
        fps, run = rows[-1][~large].view(np.uint64), run[~large]
        left = np.searchsorted(run, run, "right") - 1 - np.arange(len(run))
        a, b = _forest(fps, left, radius)
        if len(a):
            none = pa.nulls(len(a), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), none, none], names=names)

    held: list[np.ndarray] | None = None
    beyond: list | None = None  # the key of a long run that is being passed on
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            now = [batch.column(c).to_numpy() for c in (*keys, "fp")]
            if beyond is not None:
                other = np.zeros(len(now[0]) + 1, bool)
                other[-1] = True
                for k, value in zip(now[:-1], beyond):
                    other[:-1] |= k != value
                n = int(other.argmax())
                if n:
                    yield passed([r[:n] for r in now])
                now = [r[n:] for r in now]
                if not len(now[0]):
                    continue
                beyond = None
            held = now if held is None else [np.concatenate(p) for p in zip(held, now)]
        if held is None:
            continue
        change = np.zeros(len(held[0]), bool)
        for k in held[:-1]:
            change[1:] |= k[1:] != k[:-1]
        starts = np.flatnonzero(change)
        end = len(change) if batch is None else int(starts[-1]) if len(starts) else 0
        if end:
            yield from compared([r[:end] for r in held], change[:end])
            held = [r[end:] for r in held]
        if limit is not None and len(held[0]) > limit:
            yield passed(held)
            beyond, held = [k[0] for k in held[:-1]], None


_LINKS = "a bigint, b bigint, mask bigint, bucket bigint"


def links(nodes: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links ``(a, b)`` that connect all distinct fingerprints ``fp`` within ``radius`` bits.

    Each fingerprint goes into one bucket per mask, and buckets are compared whole. A bucket of more
    than ``bucket_rows`` comes back and is dealt out in blocks, every pair of blocks to a group of
    its own, so that no group grows with the data. Links of a group form a forest: as many as rows.
    """
    covering = masks(radius)
    keyed = nodes.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in covering])).alias("mask", "bucket"))
    sorted_ = keyed.repartition("mask", "bucket").sortWithinPartitions("mask", "bucket")
    found = stored(sorted_.mapInArrow(lambda b: _compare(("mask", "bucket"), radius, bucket_rows, b), _LINKS), "simhash-links")
    large = found.where("a is null").select("mask", "bucket", F.col("b").alias("fp"))
    blocks = large.groupBy("mask", "bucket").agg(F.ceil(F.count("*") / bucket_rows).cast("int").alias("blocks"))
    placed = large.join(blocks, ["mask", "bucket"]).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = placed.select("*", other.alias("other")).select("mask", "bucket", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "fp")
    pairs = pairs.repartition("mask", "bucket", "x", "y").sortWithinPartitions("mask", "bucket", "x", "y")
    more = pairs.mapInArrow(lambda b: _compare(("mask", "bucket", "x", "y"), radius, None, b), _LINKS)
    return found.where("a is not null").select("a", "b").unionAll(more.select("a", "b"))


def grouped(docs: DataFrame, *, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Rows with ``doc_id`` and ``text`` to the same with ``fp``, ``component`` and ``component_id`` for the text.

    Null and empty texts have fingerprint zero, repeated rows stay, an empty table gives an empty one. Columns
    beside these two are carried along and must not have the names that are added.
    """
    found = stored(fingerprints(docs), "simhash-fingerprints")
    nodes = found.groupBy("fp").agg(F.min("doc_id").alias("first"))
    named = components(links(nodes.select("fp"), radius, bucket_rows), "simhash-components")
    placed = nodes.join(named.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    placed = stored(placed, "simhash-nodes")
    firsts = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    linked = placed.join(firsts, "component").select("fp", "component", "component_id")
    return found.join(stored(linked, "simhash-groups"), "fp")


def near_duplicates(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row, over whole texts.

    Texts are lower-cased (A-Z) and cut into words; repeated shingles of three words count as often
    as they come, shorter texts are one shingle, texts without words (null, empty) have fingerprint
    zero. Fingerprints within ``radius`` bits are linked, and ``component_id`` is the smallest id
    that links lead to (null ids are never it, unless there is no other). Every such pair meets in a
    bucket: the covering leaves none to chance. Equal fingerprints are one node from the start, so
    large groups of copies cost nothing later. Empty tables give empty results; other columns are
    not looked at.
    """
    rows = grouped(picked(docs, doc_id=id_column, text=text_column), radius=radius, bucket_rows=bucket_rows)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The rows of ``docs`` without near-duplicates, all columns as they were, whatever their names.

    Of each group the row with the smallest id stays, of several with that id the one of the lowest
    hash, of rows that agree in both one. Groups in which all ids are null keep one row, too. Null and
    empty texts and others without words are one group; an empty table stays empty.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    one, two, first_one, first_two = (free_name(docs, n) for n in ("row_hash", "row_hash_two", "first_hash", "first_hash_two"))
    key, text = F.col(f"`{id_column}`"), F.col(f"`{text_column}`")
    # A row is known by its id and text: two independent hashes of 64 bits.
    hashed = docs.withColumns({one: F.xxhash64(key, text), two: F.xxhash64(F.lit(2), F.isnull(text), text, key)})
    narrow = hashed.select(key.alias("doc_id"), F.col(one).alias("h1"), F.col(two).alias("h2"), text.alias("text"))
    rows = grouped(narrow, radius=radius, bucket_rows=bucket_rows)
    first = F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "h1", "h2")).alias("first")
    kept = stored(rows.groupBy("component").agg(first).select(F.col("first.h1").alias(first_one), F.col("first.h2").alias(first_two)), "simhash-kept")
    joined = hashed.join(kept, (F.col(one) == F.col(first_one)) & (F.col(two) == F.col(first_two)))
    whole = F.struct(*columns)
    return joined.groupBy(one, two).agg(F.min_by(whole, F.xxhash64(whole)).alias("row")).select("row.*")
