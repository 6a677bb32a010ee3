"""Quality rules whose cutoffs are chosen under a guaranteed risk of rejecting good documents."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import Batches, free_name, picked, raw_bytes, stored

#: Of the good documents of a stratum, at most this share is rejected by the rules together...
RISK = 0.02
#: ...with this probability of being wrong about any stratum or rule.
ERROR = 0.05
SIGNALS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
#: Cutoffs of each rule from the loosest to the tightest. A score above the cutoff rejects.
GRID = {
    "symbols": (4.0, 2.0, 1.5, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1, 0.05),
    "dup_lines": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1, 0.05),
    "repeats": (0.48, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05),
    "long_words": (60.0, 40.0, 30.0, 25.0, 20.0, 17.0, 15.0, 13.0, 12.0, 11.0, 10.0, 9.0, 8.0),
    "short_words": (-1.0, -1.2, -1.5, -1.8, -2.0, -2.2, -2.5, -3.0, -3.5, -4.0),
}


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    kinds = len(number)
    pairs = ids[:-1] * kinds + ids[1:]
    if kinds > 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * kinds + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    starts = np.zeros(n, bool)
    starts[order[1:][same]] = True
    starts[order[:-1][same]] = True
    starts[1:] |= starts[:-1].copy()
    covered = starts.copy()
    covered[1:] |= starts[:-1]
    return int(np.count_nonzero(covered))


def signals_of(text: bytes) -> tuple[int, ...]:
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(b"".join(words).decode("utf-8", "replace")),
        len(text) - len(text.translate(None, b"#*$%&|<>")),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
    )


def with_signals(docs: DataFrame, text_column: str, names: dict[str, str]) -> DataFrame:
    """The rows and their signals, under the names given for them."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    added = [names[s] for s in SIGNALS]

    def run(batches: Batches) -> Batches:
        for batch in batches:
            found = np.array([signals_of(t) for t in raw_bytes(batch.column(text_column))], np.int64).reshape(-1, len(SIGNALS))
            columns = [*batch.columns, *(pa.array(found[:, i]) for i in range(len(SIGNALS)))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *added])

    return docs.mapInArrow(run, schema + "".join(f", `{a}` bigint" for a in added))


def base_failed(names: dict[str, str]) -> Column:
    words, repeats = F.col(names["n_words"]), F.col(names["n_repeat_words"])
    return (words < 50) | (100 * repeats > 50 * words)


def scores(names: dict[str, str]) -> dict[str, Column]:
    """Higher is worse. A text without words scores nothing; the base rules reject it anyway."""
    c = {s: F.col(names[s]).cast("double") for s in SIGNALS}
    words, lines = F.greatest(c["n_words"], F.lit(1.0)), F.greatest(c["n_lines"], F.lit(1.0))
    return {
        "symbols": c["n_symbols"] / words,
        "dup_lines": c["n_dup_lines"] / lines,
        "repeats": c["n_repeat_words"] / words,
        "long_words": c["word_chars"] / words,
        "short_words": -c["word_chars"] / words,
    }


def at_most(k: int, n: int, p: float) -> float:
    """Exactly, the probability of ``k`` or fewer successes of ``n``: that of so low a count if the risk were ``p``."""
    if k >= n * p:
        return 1.0  # the count does not speak for a lower risk
    log = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    term = total = math.exp(log)
    for i in range(k, 0, -1):  # terms fall from here on
        term *= i / (n - i + 1) * (1 - p) / p
        total += term
        if term < 1e-17 * total:
            break
    return total


def choose(good: np.ndarray, bad: np.ndarray, risk: float, level: float) -> int:
    """The cutoff's place in its sequence, or -1 for none.

    ``good[i]`` and ``bad[i]`` count labelled documents above exactly ``i`` of the cutoffs. Cutoffs
    are tested from the loosest on, and the first that cannot be shown to keep the risk ends the
    tests, so that the sequence needs no correction of its own. Of those that hold, the one that
    tells bad from good best is taken, the loosest of equals.
    """
    above_good = good[::-1].cumsum()[:-1]  # what exceeds the loosest exceeds all of them
    above_bad = bad[::-1].cumsum()[:-1]
    n_good, n_bad = int(good.sum()), int(bad.sum())
    best, place = 0.0, -1
    for i, (k, caught) in enumerate(zip(above_good.tolist(), above_bad.tolist())):
        if not n_good or at_most(int(k), n_good, risk) > level:
            break
        gain = caught / max(n_bad, 1) - k / n_good
        if gain > best + 1e-12:
            best, place = gain, i
    return place


def text_hashes(text: Column) -> tuple[Column, Column]:
    """Two independent hashes of 64 bits that a text is known by."""
    return F.xxhash64(text), F.xxhash64(F.lit(2), text)


def cutoffs(measured: DataFrame, labels: DataFrame, names: dict[str, str], *, stratum: str, id_column: str, hashes: tuple[str, str], risk: float, error: float) -> DataFrame:
    """One row ``(stratum, cutoffs)`` for each stratum with labels; a rule without cutoff has infinity.

    Labelled documents are only counted: per stratum and rule, by the number of cutoffs they exceed.
    A text counts once in a stratum, however many rows, ids and labels it has, for its copies say
    nothing new; of several labels the lowest quality counts.
    """
    labels = picked(labels, key="doc_id", quality="quality").where("key is not null and quality in (0, 1)")
    labels = labels.groupBy("key").agg(F.min("quality").alias("quality"))
    passed = [
        F.struct(
            F.lit(rule).alias("rule"),
            sum((F.when(score > c, 1).otherwise(0) for c in GRID[rule]), F.lit(0)).alias("passed"),
        )
        for rule, score in scores(names).items()
    ]
    counted = (
        measured.where(~base_failed(names))
        .select(F.col(f"`{id_column}`").alias("key"), F.col(stratum).alias("stratum"), F.array(*passed).alias("rules"), *[F.col(h).alias(f"h{i}") for i, h in enumerate(hashes)])
        .join(labels, "key")
        .groupBy("stratum", "h0", "h1")
        .agg(F.min("quality").alias("quality"), F.first("rules").alias("rules"))
        .select("stratum", "quality", F.explode("rules").alias("r"))
        .groupBy("stratum", "quality", "r.rule", "r.passed")
        .count()
    )
    counted = stored(counted, "quality-counts")
    tests = max(counted.select("stratum").distinct().count() * len(GRID), 1)

    def pick(group: pd.DataFrame) -> pd.DataFrame:
        chosen = []
        for rule, grid in GRID.items():
            tally = np.zeros((2, len(grid) + 1), np.int64)
            part = group[group["rule"] == rule]
            np.add.at(tally, (part["quality"].to_numpy(int), part["passed"].to_numpy(int)), part["count"].to_numpy(int))
            place = choose(tally[1], tally[0], risk / len(GRID), error / tests)
            chosen.append(grid[place] if place >= 0 else math.inf)
        return pd.DataFrame({"stratum": group["stratum"].iloc[:1], "cutoffs": [chosen]})

    return stored(counted.groupBy("stratum").applyInPandas(pick, "stratum string, cutoffs array<double>"), "quality-cutoffs")


def judged(measured: DataFrame, limits: DataFrame, names: dict[str, str], stratum: str, base: str, kept: str) -> DataFrame:
    """The rows with ``base`` (failed the base rules) and ``kept``. The join is left to Spark's size check."""
    limit, of = free_name(measured, "limit_of_rules"), free_name(measured, "stratum_of_limit")
    limits = limits.select(F.col("stratum").alias(of), F.col("cutoffs").alias(limit))
    over = [F.coalesce(score > F.col(limit)[i], F.lit(False)) for i, score in enumerate(scores(names).values())]
    rejected = over[0]
    for o in over[1:]:
        rejected = rejected | o
    joined = measured.join(limits, F.col(stratum).eqNullSafe(F.col(of)), "left").withColumn(base, base_failed(names))
    return joined.withColumn(kept, ~F.col(base) & ~rejected).drop(of, limit)


def quality_rules(
    docs: DataFrame, labels: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
    stratum_column: str = "lang", risk: float = RISK, error: float = ERROR,
) -> DataFrame:
    """``(doc_id, signals..., base_failed, kept)`` for every row, over whole texts.

    Base rules reject texts under 50 words or with over half of the words in repeated three-word
    windows. Further rules have a cutoff per stratum (null is a stratum). All labelled documents are
    holdouts, since the grid of cutoffs does not depend on data. A cutoff counts as safe if an exact
    binomial test refutes a false-rejection rate above ``risk / rules`` at level ``error / (strata *
    rules)`` (Bonferroni; fixed sequence along the grid). With probability ``1 - error`` no stratum
    loses more than ``risk`` of its good documents to the rules. Strata with too few labels get no
    cutoffs and keep everything that passes the base rules; so do those without labels.

    Null and empty texts have zero counts and fail. Repeated rows are judged each for itself, but equal
    texts of a stratum are one holdout, as the bound asks for independent ones (near copies are told
    apart); of several labels for one text the lowest quality counts, null ids and
    other label values count for nothing. Empty tables give an empty result. Other columns are not
    looked at. Only narrow rows are shuffled.
    """
    names = {s: s for s in SIGNALS}
    docs = picked(docs, doc_id=id_column, stratum=stratum_column, text=text_column).withColumn("stratum", F.col("stratum").cast("string"))
    one, two = text_hashes(F.col("text"))
    docs = docs.withColumns({"hash": one, "hash_two": two})
    measured = stored(with_signals(docs, "text", names).drop("text"), "quality-signals")
    limits = cutoffs(measured, labels, names, stratum="stratum", id_column="doc_id", hashes=("hash", "hash_two"), risk=risk, error=error)
    return judged(measured.drop("hash", "hash_two"), limits, names, "stratum", "base_failed", "kept")


def keep_good(
    docs: DataFrame, labels: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
    stratum_column: str = "lang", risk: float = RISK, error: float = ERROR,
) -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, all columns as they were.

    Texts are measured twice, once for the counts and once beside the rows, rather than shuffled. Null
    and empty texts go, repeated rows stay or go together, an empty table gives an empty one, and no
    name of a column of ``docs`` can clash.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    names = {s: free_name(docs, f"{s}_of_rules") for s in SIGNALS}
    stratum, base, kept = (free_name(docs, n) for n in ("stratum_of_rules", "base_of_rules", "kept_by_rules"))
    docs = docs.withColumn(stratum, F.col(f"`{stratum_column}`").cast("string"))
    one, two = text_hashes(F.col(f"`{text_column}`"))
    hashes = free_name(docs, "hash_of_rules"), free_name(docs, "hash_two_of_rules")
    narrow = docs.select(f"`{id_column}`", f"`{stratum}`", f"`{text_column}`", one.alias(hashes[0]), two.alias(hashes[1]))
    measured = with_signals(narrow, text_column, names).drop(text_column)
    limits = cutoffs(measured, labels, names, stratum=stratum, id_column=id_column, hashes=hashes, risk=risk, error=error)
    return judged(with_signals(docs, text_column, names), limits, names, stratum, base, kept).where(F.col(kept)).select(*columns)
