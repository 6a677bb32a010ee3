"""From raw documents to token ids: quality rules, near-duplicates, repeated passages, mixing, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluiceway.llm import bpe, mixing, quality, simhash, suffixes
from sluiceway.llm.common import forget, prepare, stored, stored_so_far, table
from sluiceway.llm.queries import BYTE_BPE, pre_token_pattern, vocabulary_file

#: Bytes from which a repeated passage is cut: 99 % of all runs of 51 words of the test documents have more.
PASSAGE_BYTES = 200

# Every stage takes whole tables with any further columns, whatever their names, and gives an empty
# table for an empty one.


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, null and empty texts among them; equal texts of a language stay or go together."""
    prepare(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints within 3 bits one stays, that of the smallest id; texts without words are one group."""
    prepare(spark)
    return simhash.keep_first(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur more than once are taken out of their documents; null and short texts stay as they are."""
    prepare(spark)
    return suffixes.repeats_removed(docs, length=PASSAGE_BYTES)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources uses it; documents without words go, a null source is one of its own."""
    prepare(spark)
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Counts and digests of the token ids, and of the text they decode to, for every row; null is empty."""
    prepare(spark)
    return bpe.digests(docs, vocabulary_file(BYTE_BPE), pre_token_pattern())


STAGES = [
    ("quality rules", keep_good),
    ("SimHash near-dedup", keep_one_of_each),
    ("suffix-array dedup", cut_repeats),
    ("mixing sources to target weights", mix),
    ("byte-level BPE encoding and decoding", encode),
]

#: Thresholds, fingerprints, seeded choices and token ids are beyond SQL; tests hold it against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written as Parquet and read again.

    What a stage stored, its input included, goes as soon as its own result is there.
    """
    docs, start = table(spark, sf_dir, "documents"), stored_so_far()
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        forget(spark, start, but_last=1)
    return STAGES[-1][1](spark, docs, sf_dir)
