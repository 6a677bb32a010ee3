"""Phrase collocations: the best-scoring phrases of each language, grown from the words with the best bounds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.common import Batches, packed, picked, raw_bytes, stored, unpacked

LEAST = 100
WORDS = 5
TOP = 2_000
#: Share of a language's words that the first expansion may start from, rare ones first.
FIRST_SHARE = 0.125
#: Bytes of text whose phrases a task counts at once (one text may have more).
BLOCK_BYTES = 16 << 20
#: Phrases that leave a task in one batch.
BATCH_ROWS = 1 << 15
UNKNOWN = "und"
_BREAK = b"."
#: Lower case for A-Z; every character that ends a piece becomes the same one.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else _BREAK[0] if chr(b) in ".,;:!?\n\v\f\r" else b for b in range(256))


def tokens(text: bytes) -> list[bytes]:
    """Words in order, a break between pieces."""
    return text.translate(_TABLE).replace(_BREAK, b" . ").split()


class _Texts:
    """Texts of one language as numbers of their distinct words, 0 for a break."""

    def __init__(self):
        self.number, self.parts, self.size = {_BREAK: 0}, [], 0

    def add(self, text: bytes) -> None:
        seen, number = self.number.setdefault, self.number
        found = [seen(w, len(number)) for w in tokens(text)]
        self.parts.append(np.array([0, *found], np.int32))
        self.size += len(text)

    def row(self, block: int, lang: str) -> pa.RecordBatch:
        ids = np.concatenate(self.parts)
        counts = np.bincount(ids, minlength=len(self.number))
        counts[0] = 0
        columns = [
            pa.array([block]), pa.array([lang]), pa.array([packed(ids)], pa.binary()),
            pa.array([list(self.number)], pa.list_(pa.binary())), pa.array([counts], pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["block", "lang", "ids", "words", "counts"])


def _blocks(limit: int, batches: Batches) -> Batches:
    held: dict[str, _Texts] = {}
    made, size, task = 0, 0, TaskContext.get().partitionId()
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), raw_bytes(batch.column("text"))):
            held.setdefault(lang, _Texts()).add(text)
            size += len(text)
            if size >= limit:
                for name, texts in held.items():
                    yield texts.row(task << 32 | made, name)
                    made += 1
                held, size = {}, 0
    for name, texts in held.items():
        yield texts.row(task << 32 | made, name)
        made += 1


_BASE = "block bigint, lang string, ids binary, words array<binary>, counts array<bigint>"


def _frequent_only(batches: Batches) -> Batches:
    """Blocks whose rare words have become breaks; ``counts`` are now those of the whole language."""
    for batch in batches:
        for at in range(len(batch)):
            row = batch.slice(at, 1)
            words, found = row.column("words").flatten(), row.column("found").flatten()
            new, places = np.zeros(len(words), np.int32), found.field("place").to_numpy()
            new[places] = np.arange(1, len(found) + 1)
            ids = new[unpacked(row.column("ids")[0].as_py())]
            ids = ids[np.concatenate([[True], (ids[1:] != 0) | (ids[:-1] != 0)])] if len(ids) else ids
            kept = pa.concat_arrays([pa.array([_BREAK], words.type), words.take(pa.array(places))])
            counts = np.concatenate([[0], found.field("a").to_numpy()])
            ends = pa.array([0, len(kept)], pa.int32())
            columns = [
                row.column("block"), row.column("lang"), pa.array([packed(ids)], pa.binary()),
                pa.ListArray.from_arrays(ends, kept), pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "lang", "ids", "words", "counts"])


_GROWN = "block bigint, lang string, place int, phrase binary, n bigint, classes binary"


def _grow(size: int, batches: Batches) -> Batches:
    """Phrases of ``size`` words that a block holds, each with a number, and a row that says which stands where.

    Expanded are those that begin or end with a word up to the language's bound (``reach``). Both
    parts of one word less must be frequent, as far as they were expanded themselves: such a part
    has a class above 0.
    """
    for batch in batches:
        for row in range(len(batch)):
            yield from _grown(size, batch.slice(row, 1))


def _grown(size: int, row: pa.RecordBatch) -> Batches:
    """The same for one block; phrases leave in batches of ``BATCH_ROWS``, spelled one batch at a time."""
    block, lang, reach, kept = (row.column(c)[0].as_py() for c in ("block", "lang", "reach", "kept"))
    words, ids = row.column("words").flatten(), unpacked(row.column("ids")[0].as_py())
    total, last = len(ids), size - 1
    rare = row.column("counts").flatten().to_numpy() <= reach
    rare[0] = False
    if size == 2:
        known = ids
    else:
        alive = np.zeros(kept["top"] + 1, np.int32)
        places = np.array(kept["places"], np.int64)
        alive[places] = places
        known = alive[unpacked(row.column("classes")[0].as_py())]
    n = max(total - last, 0)
    ends = rare[ids]
    fits = ends[:n] | ends[last : last + n]
    for step in range(size):
        fits &= ids[step : step + n] > 0
    if size > 2:
        head = ends[:n] | ends[last - 1 : last - 1 + n]
        tail = ends[1 : 1 + n] | ends[last : last + n]
        fits &= (~head | (known[:n] > 0)) & (~tail | (known[1 : 1 + n] > 0))
    at = np.flatnonzero(fits)
    # A phrase is named by its expanded part of one word less and the word that is left.
    front = ends[at]
    part = np.where(front, known[at], known[at + 1]).astype(np.int64)
    word = np.where(front, ids[at + last], ids[at])
    code = (part * len(words) + word) * 2 + front
    del part, word, front
    order = np.argsort(code, kind="stable")
    code = code[order]
    new = np.concatenate([[True], code[1:] != code[:-1]]) if len(code) else np.zeros(0, bool)
    del code
    placed = np.zeros(total, np.int32)
    placed[at[order]] = np.cumsum(new, dtype=np.int32)
    first = np.flatnonzero(new)
    n_times, begins = np.diff(np.append(first, len(at))), at[order[first]]
    del order, new, at
    names = ["block", "lang", "place", "phrase", "n", "classes"]
    for low in range(0, len(begins), BATCH_ROWS):
        begin = begins[low : low + BATCH_ROWS]
        spelled = pc.binary_join_element_wise(*[words.take(pa.array(ids[begin + step])) for step in range(size)], pa.scalar(b" ", words.type))
        columns = [
            pa.array(np.full(len(begin), block, np.int64)), pa.repeat(pa.scalar(lang, pa.string()), len(begin)),
            pa.array(np.arange(low + 1, low + 1 + len(begin), dtype=np.int32)), spelled,
            pa.array(n_times[low : low + BATCH_ROWS].astype(np.int64)), pa.nulls(len(begin), pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=names)
    columns = [pa.array([block]), pa.array([lang]), pa.array([len(begins)], pa.int32()), pa.array([None], pa.binary()), pa.array([0], pa.int64()), pa.array([packed(placed)], pa.binary())]
    yield pa.RecordBatch.from_arrays(columns, names=names)


def _frequent(rows: DataFrame, least: int, label: str) -> DataFrame:
    """Rows ``(block, lang, place, phrase, n)``, each phrase once a block, to those of frequent phrases, with ``a``.

    The counts and the rows they go back to share one shuffle.
    """
    rows = rows.repartition("lang", "phrase")
    sums = rows.groupBy("lang", "phrase").agg(F.sum("n").alias("a")).where(F.col("a") >= least)
    return stored(rows.drop("n").join(sums, ["lang", "phrase"]), label)


def _expanded(base: DataFrame, limits: DataFrame, least: int, longest: int) -> DataFrame:
    """``(lang, phrase, m, a)``: frequent phrases of two words or more that begin or end within their language's reach."""
    blocks = base.join(limits.select("lang", "reach"), "lang").where("reach > 0")
    none = F.lit(None)
    kept = F.struct(none.cast("int").alias("top"), none.cast("array<int>").alias("places"))
    level, found = blocks.withColumns({"classes": none.cast("binary"), "kept": kept}), []
    for size in range(2, longest + 1):
        grown = level.mapInArrow(lambda b, size=size: _grow(size, b), _GROWN)
        grown = stored(grown, f"phrases-grown-{size}")
        hits = _frequent(grown.where("classes is null").drop("classes"), least, f"phrases-frequent-{size}")
        found.append(hits.select("lang", "phrase", F.lit(size).alias("m"), "a").distinct())
        if size < longest:
            places = hits.groupBy("block").agg(F.collect_list("place").alias("places"))
            state = grown.where("classes is not null").select("block", F.col("place").alias("top"), "classes").join(places, "block", "left")
            state = state.select("block", "classes", F.struct("top", F.coalesce("places", F.array().cast("array<int>")).alias("places")).alias("kept"))
            level = blocks.join(state, "block")
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return stored(out, "phrases-expanded")


def _part(phrase, first: int, n):
    """Some of a phrase's words."""
    return F.concat_ws(" ", F.slice(F.split(phrase.cast("string"), " "), first, n))


def _scored(words: DataFrame, phrases: DataFrame, limits: DataFrame, longest: int) -> DataFrame:
    """Phrases that begin and end within reach, with their lowest cut and whether a longer one stands for them.

    All parts of such a phrase were expanded, so that every count a score needs is there.
    """
    known = words.select("lang", "phrase", "a").unionAll(phrases.select("lang", "phrase", "a"))
    cuts = phrases.select("lang", "phrase", "m", "a", F.explode(F.expr("sequence(1, m - 1)")).alias("k"))
    text = F.col("phrase")
    cuts = cuts.withColumns({"head": _part(text, F.lit(1), F.col("k")).cast("binary"), "tail": _part(text, F.col("k") + 1, F.col("m")).cast("binary")})
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l")), ["lang", "head"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r")), ["lang", "tail"])
    cuts = cuts.join(limits, "lang")
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "n", "l", "r")}
    score = F.expr("cast(1000 as decimal(4,0)) * wide.a * wide.n div (wide.l * wide.r)")
    cuts = cuts.withColumn("wide", F.struct(*[v.alias(c) for c, v in wide.items()])).withColumn("score", score)
    best = F.min(F.struct("score", "k", "l", "r")).alias("best")
    # The first cut has the first word on its left, the last one the last word on its right.
    ends = F.max(F.when(F.col("k") == 1, F.col("l"))), F.max(F.when(F.col("k") == F.col("m") - 1, F.col("r")))
    made = cuts.groupBy("lang", "phrase", "m", "a", "n", "reach").agg(best, *[e.alias(f"end{i}") for i, e in enumerate(ends)], F.count("*").alias("cuts"))
    made = made.where("end0 <= reach and end1 <= reach and cuts = m - 1")
    longer = phrases.where("m > 2").select("lang", "a", F.explode(F.array(_part(text, F.lit(1), F.col("m") - 1), _part(text, F.lit(2), F.col("m")))).alias("phrase"))
    longer = longer.select("lang", "a", F.col("phrase").cast("binary").alias("phrase")).distinct()
    made = made.join(longer, ["lang", "phrase", "a"], "left_anti")
    return made.select("lang", "phrase", "a", "n", F.col("best.l").alias("l"), F.col("best.r").alias("r"), F.col("best.score").alias("score"))


def collocations(
    docs: DataFrame, *, lang_column: str = "lang", text_column: str = "text", least: int = LEAST, longest: int = WORDS,
    top: int = TOP, first_share: float = FIRST_SHARE, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of each language, over whole texts.

    A phrase has two to ``longest`` words of one piece and occurs ``a >= least`` times; its score is
    the lowest ``1000 * a * n div (l * r)`` of its cuts into two parts. Phrases inside a longer one
    that is just as frequent are left out.

    Growth is best first. No phrase that begins with a word of count f can score above ``1000 * n /
    f``, since it is no more frequent than what is left of it; nor can one that ends with it. So the
    words of lowest count have the best bounds and are expanded first, up to the language's reach;
    phrases grow word by word from frequent ones. The score at place ``top`` then says how far the
    reach has to go for the bound of all other words to lie below it (equal scores included), and a
    language is settled when its reach is that far. Parts of a phrase within reach are within reach
    themselves, so its counts are all exact.

    Null texts are empty, a null language is ``und`` and one with a language of that name. Repeated
    rows count each; empty tables and those without frequent phrases give an empty result; other
    columns are not looked at. A block of texts never holds more than ``block_bytes`` and one text;
    rare words are dropped before anything is grown, and what is shuffled is one row for each phrase
    of a block that may be frequent.
    """
    narrow = picked(docs, lang=lang_column, text=text_column).select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), "text")
    base = stored(narrow.mapInArrow(lambda b: _blocks(block_bytes, b), _BASE), "phrases-blocks")
    said = base.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "w"))
    said = said.select("block", "lang", "place", F.col("w.words").alias("phrase"), F.col("w.counts").alias("n")).where("n > 0")
    totals = base.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("bigint"), lambda s, c: s + c)).alias("n")).where("n > 0")
    totals = stored(totals, "phrases-totals")
    hits = _frequent(said, least, "phrases-words")
    words = stored(hits.select("lang", "phrase", "a").distinct(), "phrases-vocabulary")
    places = hits.groupBy("block").agg(F.collect_list(F.struct("place", "a")).alias("found"))
    base = stored(base.join(places, "block", "left").mapInArrow(_frequent_only, _BASE), "phrases-base")
    # Counts on a scale of eighths of a power of two: a few hundred steps, however many words there are.
    step = F.ceil(F.log2("a") * 8)
    steps = words.groupBy("lang", step.alias("step")).agg(F.sum("a").alias("words"), F.max("a").alias("most"))
    so_far = F.sum("words").over(Window.partitionBy("lang").orderBy("step"))
    steps = steps.withColumn("before", so_far - F.col("words")).join(totals, "lang")
    limits = steps.groupBy("lang", "n").agg(F.max("most").alias("most"), F.max(F.when(F.col("before") <= F.col("n") * first_share, F.col("most"))).alias("reach"))
    limits = stored(limits, "phrases-limits")
    ranked = None
    while True:
        phrases = _expanded(base, limits, least, longest)
        scored = _scored(words, phrases, limits, longest)
        order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
        now = scored.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top)
        now = stored(now, "phrases-ranked")
        last = now.where(F.col("rank") == top).select("lang", F.col("score").alias("last"))
        # The reach at which all that is left out scores below the last one: beyond 1000 * n / last.
        due = limits.join(last, "lang", "left").withColumn("due", F.least("most", F.coalesce(F.expr("cast(1000 * cast(n as decimal(20,0)) div last as bigint)"), F.col("most"))))
        due = stored(due, "phrases-due")
        settled = now.join(due.where("reach >= due").select("lang"), "lang", "left_semi")
        ranked = settled if ranked is None else ranked.unionAll(settled)
        limits = due.where("reach < due").select("lang", "n", "most", F.col("due").alias("reach"))
        if limits.isEmpty():
            break
        base = base.join(limits.select("lang"), "lang", "left_semi")
        words = words.join(limits.select("lang"), "lang", "left_semi")
    return ranked.select("lang", "rank", F.col("phrase").cast("string").alias("phrase"), "a", "l", "r", "n", "score")
