"""Importance resampling: documents drawn at random, weighted towards a target text by hashed word runs."""

from __future__ import annotations

import math
from collections import Counter
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import Batches, free_name, picked, raw_bytes, stored

BUCKETS = 10_000
#: The longest run of words that is a feature.
RUN = 3
#: Documents with fewer words are never drawn.
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
#: Lower case for A-Z; a blank for every other ASCII byte that is neither letter nor digit.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def features(text: bytes, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """The number of words, and the bucket of every run of one to three of them.

    The checksum of a run goes on from that of the run without its last word.
    """
    words = text.translate(TABLE).split()
    sums = list(map(crc32, words))
    found = [np.fromiter(sums, np.int64, len(sums))]
    spaced = [b" " + w for w in words]
    for step in range(1, min(RUN, len(words))):
        sums = list(map(crc32, spaced[step:], sums))  # the shorter list ends it
        found.append(np.fromiter(sums, np.int64, len(sums)))
    return len(words), np.concatenate(found) % buckets


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Rows with ``text`` to ``(bucket, n)``: every task sends its sums, at most one row per bucket."""

    def run(batches: Batches) -> Batches:
        counter: Counter[int] = Counter()
        for batch in batches:
            tally = np.zeros(buckets, np.int64)
            for text in raw_bytes(batch.column("text")):
                tally += np.bincount(features(text, buckets)[1], minlength=buckets)
            hit = np.flatnonzero(tally)
            counter.update(dict(zip(hit.tolist(), tally[hit].tolist())))
        yield pa.RecordBatch.from_arrays([pa.array(list(counter), pa.int32()), pa.array(list(counter.values()), pa.int64())], names=["bucket", "n"])

    return texts.select("text").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: Counter, target: Counter, buckets: int = BUCKETS) -> np.ndarray:
    """Per bucket, a thousand times the log of how much likelier it is in the target, both smoothed by one."""
    all_raw, all_target = float(sum(raw.values()) + buckets), float(sum(target.values()) + buckets)
    return np.array([math.floor(1000 * math.log((target[b] + 1.0) * all_raw / ((raw[b] + 1.0) * all_target))) for b in range(buckets)], np.int64)


def _tally(texts: DataFrame, buckets: int) -> Counter:
    """At most one row per bucket reaches the driver."""
    return Counter({r.bucket: r.n for r in bucket_counts(texts, buckets).collect()})


def weights(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """Rows with ``text`` to the same rows with ``n_words``, ``n_features`` and ``weight`` instead."""
    rest = [f for f in docs.schema if f.name != "text"]
    names, buckets = [f.name for f in rest] + ["n_words", "n_features", "weight"], len(gain)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            found = [(n, len(hit), int(gain[hit].sum())) for n, hit in map(features, raw_bytes(batch.column("text")), repeat(buckets))]
            columns = np.array(found, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in rest), *(pa.array(columns[:, i]) for i in range(3))], names=names)

    return docs.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rest) + ", n_words bigint, n_features bigint, weight bigint")


def noise(key: Column, seed: int) -> Column:
    """A thousand times a Gumbel variate that only the seed and the id decide."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def _ranked(rows: DataFrame, percent: int, least_words: int) -> DataFrame:
    """``rank`` for the best of the rows, null for the others, without bringing them into one task.

    Rows are dealt out by ranges of the order and numbered inside a range; the ranges' sizes, one
    number each, say where a range's numbers begin. Equal rows are told apart by where they are stored.
    """
    spark = rows.sparkSession
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight"), F.col("place")]
    able = rows.where(F.col("n_words") >= least_words).withColumn("place", F.monotonically_increasing_id())
    dealt = able.repartitionByRange(*order).sortWithinPartitions(*order)
    # The identifier holds the task in its upper bits and the place within it in the lower 33.
    dealt = stored(dealt.withColumn("place", F.monotonically_increasing_id()), "resample-ranges")
    dealt = dealt.withColumn("part", F.shiftright("place", 33))
    draws, before = 0, []
    for part, n in sorted(tuple(r) for r in dealt.groupBy("part").count().collect()):
        before.append((part, draws))
        draws += n
    draws = percent * draws // 100
    numbered = dealt.join(spark.createDataFrame(before, "part bigint, before bigint"), "part")
    rank = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    numbered = numbered.withColumn("rank", F.when(rank <= draws, rank)).select(*rows.columns, "rank")
    return numbered.unionAll(rows.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("bigint")))


def _resample(docs: DataFrame, target: DataFrame, buckets: int, percent: int, least_words: int, seed: int) -> DataFrame:
    gain = gains(_tally(docs, buckets), _tally(target, buckets), buckets)
    scored = weights(docs, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    return _ranked(stored(scored, "resample-weights"), percent, least_words)


def resample(
    docs: DataFrame, target: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", target_column: str = "text",
    buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED,
) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score, rank)`` for every row of ``docs``, over whole texts.

    A document's weight is the sum of its features' gains, its score adds Gumbel noise from its id;
    the highest ``percent`` of those with ``least_words`` or more are drawn and ranked. That is a draw
    without replacement in proportion to the importance weights, the same in every run.

    Null and empty texts have no features and weight 0. Ties go to the smaller id, null ids last; a
    null id takes the noise of an empty one. Repeated rows are scored and ranked each for itself.
    With an empty table of documents the result is empty; with an empty target, gains compare with a
    uniform distribution. Other columns are not looked at. Beside the counts of ``buckets``, nothing
    reaches the driver but one number per range of the order.
    """
    docs = picked(docs, doc_id=id_column, text=text_column)
    return _resample(docs, picked(target, text=target_column), buckets, percent, least_words, seed)


def drawn(
    docs: DataFrame, target: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", target_column: str = "text",
    buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED,
) -> DataFrame:
    """The rows of ``docs`` that ``resample`` draws, all columns as they were, whatever their names.

    A row is known by two hashes of its id and text, so rows that repeat both are drawn together.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    one, two = free_name(docs, "row_hash"), free_name(docs, "row_hash_two")
    key, text = F.col(f"`{id_column}`"), F.col(f"`{text_column}`")
    hashed = docs.withColumns({one: F.xxhash64(key, text), two: F.xxhash64(F.lit(2), F.isnull(text), text, key)})
    rows = hashed.select(key.alias("doc_id"), text.alias("text"), F.col(one).alias("h1"), F.col(two).alias("h2"))
    found = _resample(rows, picked(target, text=target_column), buckets, percent, least_words, seed).where("rank is not null")
    return hashed.join(found.select(F.col("h1").alias(one), F.col("h2").alias(two)), [one, two], "left_semi").select(*columns)
