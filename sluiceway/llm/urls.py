"""URL rules in a sorted array of 64-bit digests, memory-mapped and probed by binary search."""

from __future__ import annotations

import functools
import mmap
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import Batches, create_file, picked, stored
from sluiceway.session import scratch_path

SEED = 42
#: Rules in one file of the array, about; files are ranges of digests.
FILE_RULES = 4_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
VERDICTS = ("allow", "block")


def with_host_and_path(pages: DataFrame, url: str = "url") -> DataFrame:
    """``host`` (A-Z lower-cased) and ``path`` of a url; both empty without ``://``."""
    part = lambda n: F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", n), F.lit(""))
    return pages.withColumn("host", F.translate(part(1), UPPER, LOWER)).withColumn("path", part(2))


def _write(folder: str, batches: Batches) -> Batches:
    """Rows ``(digest, rule, verdict, path_length)`` in the order of unsigned digests to a file of the array."""
    tables = [pa.Table.from_batches([b]) for b in batches]
    rows = pa.concat_tables(tables) if tables else None
    if not rows:
        return
    task = TaskContext.get()
    path = f"{folder}/rules-{task.partitionId():05d}-{task.taskAttemptId()}.bin"
    texts = [r.encode() for r in rows.column("rule").to_pylist()]
    ends = np.cumsum([len(t) for t in texts], dtype=np.uint64)
    lengths = np.unique(rows.column("path_length").to_numpy()).astype(np.uint64)
    keys = rows.column("digest").to_numpy().view(np.uint64)
    verdicts = np.array([VERDICTS.index(v) for v in rows.column("verdict").to_pylist()], np.uint8)
    with create_file(path) as file:
        for part in (np.array([len(texts), len(lengths)], np.uint64), lengths, keys, ends):
            file.write(part.tobytes())
        file.write(verdicts.tobytes())
        file.write(b"".join(texts))
    yield pa.record_batch({"path": [path], "rules": pa.array([len(texts)], pa.int64())})


def build(rules: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the array from rows ``(rule, verdict)``; a stored row ``(path, rules)`` per file.

    A rule is a host and the beginning of a path, as in ``example.org/en/``. Digests are 64-bit
    XXH64; Spark sorts them by range, so that no task sees more than its file. Null rules and rules
    without ``/`` fit nothing and are left out; of several verdicts for one rule, block stands.
    """
    folder = folder or scratch_path(rules.sparkSession, "url-rules")
    rules = picked(rules, rule="rule", verdict="verdict").where("rule like '%/%' and verdict in ('allow', 'block')")
    host = F.translate(F.substring_index("rule", "/", 1), UPPER, LOWER)
    path = F.expr("substring(rule, locate('/', rule))")
    rules = rules.select(F.concat(host, path).alias("rule"), F.length(path).alias("path_length"), "verdict")
    rules = rules.groupBy("rule", "path_length").agg(F.max("verdict").alias("verdict"))
    rules = rules.withColumn("digest", F.xxhash64("rule")).withColumn("order", F.expr("digest ^ -9223372036854775808L"))
    rules = stored(rules, "url-rules")
    files = max(1, -(-rules.count() // FILE_RULES))
    placed = rules.repartitionByRange(files, "order").sortWithinPartitions("order", "rule")
    written = placed.select("digest", "rule", "verdict", "path_length").mapInArrow(lambda b: _write(folder, b), "path string, rules bigint")
    return stored(written, "url-rule-files")


class Rules:
    """The files of the array, mapped into memory: pages are read as they are probed."""

    def __init__(self, paths: Iterable[str]):
        self.parts, lengths = [], set()
        for path in paths:
            with open(path, "rb") as file:
                held = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
            n, kinds = np.frombuffer(held, np.uint64, 2).tolist()
            at = 16
            lengths |= set(np.frombuffer(held, np.uint64, kinds, at).tolist())
            at += 8 * kinds
            keys, ends = np.frombuffer(held, np.uint64, n, at), np.frombuffer(held, np.uint64, n, at + 8 * n)
            at += 16 * n
            self.parts.append((keys, ends, np.frombuffer(held, np.uint8, n, at), held, at + n))
        self.parts.sort(key=lambda p: int(p[0][0]))
        self.firsts = np.array([p[0][0] for p in self.parts], np.uint64)
        self.path_lengths = sorted(lengths, reverse=True)

    def find(self, texts: list[bytes]) -> list[int | None]:
        """The verdict of each text that is a rule. Equal digests are told apart by the stored string."""
        import xxhash

        found: list[int | None] = [None] * len(texts)
        if not self.parts or not texts:
            return found
        digests = np.array([xxhash.xxh64_intdigest(t, seed=SEED) for t in texts], np.uint64)
        last = np.searchsorted(self.firsts, digests, "right") - 1
        first = np.maximum(np.searchsorted(self.firsts, digests, "left") - 1, 0)
        for i, (keys, ends, verdicts, held, start) in enumerate(self.parts):
            here = np.flatnonzero((first <= i) & (i <= last))
            left, right = (np.searchsorted(keys, digests[here], side) for side in ("left", "right"))
            for j, a, b in zip(here[left < right].tolist(), left[left < right].tolist(), right[left < right].tolist()):
                for k in range(a, b):
                    begin = int(ends[k - 1]) if k else 0
                    if held[start + begin : start + int(ends[k])] == texts[j]:
                        found[j] = int(verdicts[k])
        return found


@functools.lru_cache(maxsize=2)
def _rules(paths: tuple[str, ...]) -> Rules:
    return Rules(paths)


def judge(pages: DataFrame, array: DataFrame, *, id_column: str = "page_id", url_column: str = "url", default: str = "allow") -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for every row.

    A rule fits its host and all subdomains if the url's path starts with the rule's; the longest
    rule wins (of equals the one with the longer host). Without a rule the verdict is ``default``.
    A url is probed for each of its host's suffixes with each length of path that rules have.
    Null urls and those without ``://`` have neither host nor path and fit no rule. Repeated rows
    are judged each for itself; an empty array or table is fine. Files of the array go to each
    executor once and are mapped there, so memory does not grow with the number of rules.
    """
    spark = pages.sparkSession
    names = []
    for row in array.collect():  # one row per file
        spark.sparkContext.addFile(row.path)
        names.append(row.path.rpartition("/")[2])
    pages = with_host_and_path(picked(pages, page_id=id_column, url=url_column)).select("page_id", "host", "path")
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Batches) -> Batches:
        rules = _rules(tuple(SparkFiles.get(n) for n in names))
        suffixes: dict[str, list[str]] = {}
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            tried, owner = [], []
            for i, (host, path) in enumerate(zip(hosts, paths)):
                if host not in suffixes:
                    if len(suffixes) > 100_000:
                        suffixes.clear()
                    labels = host.split(".")
                    suffixes[host] = [".".join(labels[k:]) for k in range(len(labels))]
                for length in rules.path_lengths:
                    if length <= len(path):
                        begin = path[:length]
                        tried += [suffix + begin for suffix in suffixes[host]]
                        owner += [i] * len(suffixes[host])
            best: list[tuple[int, int, str, int] | None] = [None] * len(hosts)
            for i, rule, verdict in zip(owner, tried, rules.find([t.encode() for t in tried])):
                if verdict is not None:
                    fit = (len(rule), rule.index("/"), rule, verdict)
                    best[i] = fit if best[i] is None else max(best[i], fit)
            yield pa.record_batch(
                {
                    "page_id": batch.column("page_id"), "host": batch.column("host"), "path": batch.column("path"),
                    "rule": pa.array([b and b[2] for b in best], pa.string()),
                    "verdict": pa.array([VERDICTS[b[3]] if b else default for b in best], pa.string()),
                }
            )

    return pages.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string")
