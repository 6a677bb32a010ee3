"""Repeated byte strings across a corpus, by common-prefix interval trees over sparse suffix arrays."""

from __future__ import annotations

import functools
import hashlib
import itertools
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import Batches, free_name, picked, pieces, raw_bytes, stored, varied

#: The shortest string whose repeats count.
LENGTH = 400
#: Bytes of an anchor. Every string of LENGTH holds at least one, at a place that only its bytes decide.
GRAM = 64
#: Bytes of text that are hashed at once; longer texts are taken in overlapping parts.
PART_BYTES = 1 << 20
#: Contexts that a task sorts at once, at most. Those of an anchor with more get longer keys.
GROUP_ROWS = 50_000
_PLACE = np.uint64((1 << 24) - 1)
_PAD = b"\xff"  # never occurs in UTF-8
_ODD = 0x9E3779B97F4A7C15


@functools.lru_cache(maxsize=2)
def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    both = []
    for b in (base, pow(base, -1, 1 << 64)):
        steps = np.full(n, b, np.uint64)
        steps[0] = 1
        both.append(np.multiply.accumulate(steps))
    return both[0], both[1]


@functools.lru_cache(maxsize=4)
def _byte_values(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


def window_hashes(data: np.ndarray, width: int, seed: int = 3) -> np.ndarray:
    """A 64-bit hash of every ``width`` bytes, that is of one for each place they can start at."""
    n = len(data)
    if n < width:
        return np.zeros(0, np.uint64)
    powers, inverse = _powers(1 << max(n - 1, 1).bit_length(), 0xD1342543DE82EF95 + 8 * seed)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_byte_values(seed)[data] * powers[:n], out=sums[1:])
    found = (sums[width:] - sums[:-width]) * inverse[: n - width + 1]
    found ^= found >> np.uint64(29)
    found *= np.uint64(_ODD)
    return found ^ found >> np.uint64(32)


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row, by running minima of blocks from both sides."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(texts: list[bytes], length: int, gram: int, part: int = PART_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, hash) of the leftmost lowest gram of every ``length`` bytes, each once.

    About ``part`` bytes are joined at a time, however long a text is, so that a place among them
    fits into the low bits of a hash.
    """
    part = min(part, int(_PLACE) + 2 - length)
    cuts = [(i, at) for i, t in enumerate(texts) for at in range(0, len(t) - length + 1, part)]
    views = [memoryview(texts[i])[at : at + part + length - 1] for i, at in cuts]
    keys, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for a, b in pieces(views, part + length - 1):
        text, offset = np.array(cuts[a:b], np.int64).T
        sizes = np.array([len(v) for v in views[a:b]])
        starts = np.cumsum(sizes) - sizes
        hashes = window_hashes(np.frombuffer(b"".join(views[a:b]), np.uint8), gram)
        ranked = hashes & ~_PLACE | np.arange(len(hashes), dtype=np.uint64)
        least = _sliding_least(ranked, length - gram + 1)
        places = (least[varied(starts, sizes - length + 1)] & _PLACE).astype(np.int64)
        places = places[np.concatenate([[True], places[1:] != places[:-1]])]
        which = np.searchsorted(starts, places, "right") - 1
        keys.append(text[which] << 40 | places - starts[which] + offset[which])
        found.append(hashes[places])
    key, first = np.unique(np.concatenate(keys), return_index=True)
    return key >> 40, key & ((1 << 40) - 1), np.concatenate(found)[first]


class _Tree:
    """Repeats among the suffixes of one anchor.

    Suffixes stand in lexical order with the length each shares with the next. A stack scan closes
    the common-prefix intervals from the longest prefix to the shortest. An interval knows its
    members by their rank in the order of what lies left of the anchor; when two intervals merge,
    each member of the smaller one meets its neighbours in the larger one, and the two share
    ``depth`` bytes to the right and the least of the shared left lengths between them to the left.
    Other pairs share no more on either side, so the reach found for each member is the whole one.
    """

    def __init__(self, shared_right: list[int], rank: list[int], shared_left: list[int], left: list[int], right: list[int], length: int):
        self.shared_right, self.rank, self.length = shared_right, rank, length
        self.left, self.right = left, right  # by rank: bytes there are on either side
        self.reach_left, self.reach_right = [0] * len(rank), [0] * len(rank)
        self.least = [shared_left]  # least of ranges of 2, 4, 8... shared lengths
        while len(self.least[-1]) > 1 << len(self.least) - 1:
            step, last = 1 << len(self.least) - 1, self.least[-1]
            self.least.append([a if a < b else b for a, b in zip(last, last[step:])])

    def _meet(self, a: int, b: int, depth: int) -> None:
        level = (b - a).bit_length() - 1
        row = self.least[level]
        shared = min(row[a], row[b - (1 << level)])
        for x in (a, b):
            before, after = min(shared, self.left[x]), min(depth, self.right[x])
            if before + after >= self.length:
                self.reach_left[x] = max(self.reach_left[x], before)
                self.reach_right[x] = max(self.reach_right[x], after)

    def _merge(self, one: list[int], two: list[int], depth: int) -> list[int]:
        if len(one) < len(two):
            one, two = two, one
        for x in two:
            at = bisect_left(one, x)
            if at:
                self._meet(one[at - 1], x, depth)
            if at < len(one):
                self._meet(x, one[at], depth)
            one.insert(at, x)
        return one

    def scan(self) -> tuple[list[int], list[int]]:
        """How far each suffix (by its left rank) repeats before and after the anchor."""
        stack: list[tuple[int, list[int]]] = []
        for x, depth in zip(self.rank, [*self.shared_right, -1]):
            members = [x]
            while stack and stack[-1][0] >= depth:
                shared, others = stack.pop()
                members = self._merge(others, members, shared)
            stack.append((depth, members))
        return self.reach_left, self.reach_right


def _first_difference(rows: np.ndarray) -> np.ndarray:
    """Per row and the next one, the bytes they share from the beginning."""
    unlike = rows[1:] != rows[:-1]
    return np.where(unlike.any(axis=1), unlike.argmax(axis=1), rows.shape[1])


def reaches(group: np.ndarray, lead: np.ndarray, contexts: list[bytes], copies: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Per anchor, how far it repeats elsewhere to the left and to the right (0 and 0: no repeat of ``length``).

    ``contexts`` hold up to ``length - gram`` bytes before each anchor (``lead`` of them) and
    ``length`` from it on. No two of a group are alike; ``copies`` says how often each occurs.
    """
    n, left_width = len(contexts), length - gram
    after = np.array([len(c) for c in contexts]) - lead
    padded = [c[k:].ljust(length, _PAD) + c[:k][::-1].ljust(left_width, _PAD) for c, k in zip(contexts, lead.tolist())]
    rows = np.frombuffer(b"".join(padded), np.uint8).reshape(n, length + left_width)
    order = np.argsort(rows.view(f"S{rows.shape[1]}").ravel(), kind="stable")
    order = order[np.argsort(group[order], kind="stable")]
    rows, group, before, after, copies = rows[order], group[order], lead[order], after[order], copies[order]
    reach_left, reach_right = np.zeros(n, np.int64), np.zeros(n, np.int64)
    long = (copies > 1) & (before + after >= length)
    reach_left[long], reach_right[long] = before[long], after[long]
    begin = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    members = np.diff(np.append(begin, n))
    to_next_right, to_next_left = _first_difference(rows[:, :length]), _first_difference(rows[:, length:])
    two = begin[members == 2]
    for x in (two, two + 1):
        l, r = np.minimum(to_next_left[two], before[x]), np.minimum(to_next_right[two], after[x])
        fits = l + r >= length
        reach_left[x[fits]] = np.maximum(reach_left[x[fits]], l[fits])
        reach_right[x[fits]] = np.maximum(reach_right[x[fits]], r[fits])
    for a, m in zip(begin[members > 2].tolist(), members[members > 2].tolist()):
        lefts = rows[a : a + m, length:]
        by_left = np.argsort(np.ascontiguousarray(lefts).view(f"S{left_width}").ravel(), kind="stable")
        rank = np.empty(m, np.int64)
        rank[by_left] = np.arange(m)
        tree = _Tree(
            to_next_right[a : a + m - 1].tolist(), rank.tolist(), _first_difference(lefts[by_left]).tolist(),
            before[a + by_left].tolist(), after[a + by_left].tolist(), length,
        )
        for reach, found in zip((reach_left, reach_right), tree.scan()):
            reach[a + by_left] = np.maximum(reach[a + by_left], found)
    out = np.zeros((2, n), np.int64)
    out[0][order], out[1][order] = reach_left, reach_right
    return out[0], out[1]


def _scan(length: int, gram: int, batches: Batches) -> Batches:
    """The distinct anchors of each text, and whether it holds them once or more often."""
    for batch in batches:
        texts, keys = raw_bytes(batch.column("text")), batch.column("key")
        for a, b in pieces(texts, PART_BYTES):
            part = texts[a:b]
            text, _, found = anchors(part, length, gram)
            order = np.lexsort((found, text))
            text, found = text[order], found[order]
            first = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (found[1:] != found[:-1])])) if len(text) else text
            times = np.minimum(np.diff(np.append(first, len(text))), 2)
            offsets = pa.array(np.searchsorted(text[first], np.arange(len(part) + 1)).astype(np.int32))
            yield pa.record_batch(
                {
                    "key": keys[a:b], "n_bytes": pa.array([len(t) for t in part], pa.int64()),
                    "hashes": pa.ListArray.from_arrays(offsets, pa.array(found[first].view(np.int64))),
                    "times": pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
                }
            )


def _context_hashes(texts: list[bytes], text: np.ndarray, place: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the bytes around each anchor, which are also those of how many there are on either side."""
    left = length - gram
    width = left + length
    one, two = np.zeros(len(text), np.uint64), np.zeros(len(text), np.uint64)
    sizes = np.array([len(t) for t in texts], np.int64)
    whole = (place >= left) & (place + length <= sizes[text])
    cuts = [(i, at) for i, t in enumerate(texts) for at in range(0, len(t) - width + 1, PART_BYTES)]
    views = [memoryview(texts[i])[at : at + PART_BYTES + width - 1] for i, at in cuts]
    first_cut = np.searchsorted([i for i, _ in cuts], np.arange(len(texts)))
    row = np.flatnonzero(whole)
    cut, offset = first_cut[text[row]] + (place[row] - left) // PART_BYTES, (place[row] - left) % PART_BYTES
    for a, b in pieces(views, PART_BYTES + width - 1):
        low, high = np.searchsorted(cut, [a, b])
        if low < high:
            starts = np.cumsum([0, *(len(v) for v in views[a:b])])
            data = np.frombuffer(b"".join(views[a:b]), np.uint8)
            at = starts[cut[low:high] - a] + offset[low:high]
            one[row[low:high]], two[row[low:high]] = (window_hashes(data, width, seed)[at] for seed in (11, 12))
    for i in np.flatnonzero(~whole).tolist():
        data, at = texts[text[i]], int(place[i])
        lead = min(at, left)
        digest = hashlib.blake2b(data[at - lead : at + length], digest_size=16, salt=lead.to_bytes(4, "little")).digest()
        one[i], two[i] = np.frombuffer(digest, np.uint64)
    return one, two


_PLACES = "key binary, hash bigint, c1 bigint, c2 bigint, n bigint, firsts array<bigint>, lasts array<bigint>"
_CONTEXTS = "hash bigint, c1 bigint, c2 bigint, n bigint, lead int, context binary"


def _contexts(length: int, gram: int, bytes_too: bool, batches: Batches) -> Batches:
    """Rows (key, text, hashes): the anchors that occur again, by what stands around them.

    Without bytes there is a row per text and context, with the places as runs: what lies between two
    places up to ``length`` apart repeats if they do. With bytes there is a row per context and range.
    """
    for batch in batches:
        texts, keys = raw_bytes(batch.column("text")), batch.column("key")
        for a, b in pieces(texts, PART_BYTES):
            part = texts[a:b]
            text, place, found = anchors(part, length, gram)
            hit = np.isin(found, np.unique(batch.column("hashes")[a:b].flatten().to_numpy()).view(np.uint64))
            text, place, found = text[hit], place[hit], found[hit]
            one, two = _context_hashes(part, text, place, length, gram)
            owner = np.zeros(len(text), np.int64) if bytes_too else text
            order = np.lexsort((place, text, two, one, owner))
            text, place, found, one, two, owner = (x[order] for x in (text, place, found, one, two, owner))
            new = np.ones(len(text), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])
            first = np.flatnonzero(new)
            if not len(first):
                continue
            columns = [pa.array(x[first].view(np.int64)) for x in (found, one, two)] + [pa.array(np.diff(np.append(first, len(text))))]
            if bytes_too:
                lead = np.minimum(place[first], length - gram)
                around = [part[t][p - k : p + length] for t, p, k in zip(text[first].tolist(), place[first].tolist(), lead.tolist())]
                columns += [pa.array(lead.astype(np.int32)), pa.array(around, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["hash", "c1", "c2", "n", "lead", "context"])
                continue
            apart = new.copy()
            apart[1:] |= place[1:] - place[:-1] > length
            runs = np.flatnonzero(apart)
            offsets = pa.array(np.append(np.searchsorted(runs, first), len(runs)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (place[runs], place[np.append(runs[1:], len(text)) - 1])]
            names = ["key", "hash", "c1", "c2", "n", "firsts", "lasts"]
            yield pa.RecordBatch.from_arrays([keys[a:b].take(pa.array(text[first])), *columns, *lists], names=names)


_REACHES = "c1 bigint, c2 bigint, l int, r int"


def _group(length: int, gram: int, batches: Batches) -> Batches:
    """Contexts sorted by cell, each once, to how far each repeats in its cell."""

    def settled(rows: pa.Table) -> Batches:
        rows = rows.combine_chunks()
        cell, lead, copies = (rows.column(c).to_numpy() for c in ("cell", "lead", "n"))
        left, right = reaches(cell, lead.astype(np.int64), rows.column("context").to_pylist(), copies, length, gram)
        hit = np.flatnonzero(left + right >= length)
        if len(hit):
            ids = [rows.column(c).to_numpy()[hit] for c in ("c1", "c2")]
            columns = [*map(pa.array, ids), *(pa.array(x[hit].astype(np.int32)) for x in (left, right))]
            yield pa.RecordBatch.from_arrays(columns, names=["c1", "c2", "l", "r"])

    held: list[pa.Table] = []
    for batch in itertools.chain(batches, [None]):
        if batch is not None and len(batch):
            cells = batch.column("cell").to_numpy()
            held.append(pa.Table.from_batches([batch]))
            if cells[0] == cells[-1] and (len(held) == 1 or held[0].column("cell")[0].as_py() == cells[0]):
                continue  # all one cell so far
        if not held:
            continue
        rows = pa.concat_tables(held)
        cells = rows.column("cell").to_numpy()
        end = len(cells) if batch is None else int(np.flatnonzero(cells != cells[-1])[-1]) + 1 if cells[0] != cells[-1] else 0
        if end:
            yield from settled(rows.slice(0, end))
        held = [rows.slice(end)] if end < len(cells) else []


def steps(span: int) -> list[int]:
    """How many bytes the keys of each refinement leave out: ever fewer, each number dividing the one before, at last none."""
    out, last = [], span
    while last > 1:
        last = max(d for d in range(1, max(last // 3, 1) + 1) if last % d == 0)
        if last > 1:
            out.append(last)
    return [*out, 0]


_CELLS = "c1 bigint, c2 bigint, j int, w1 bigint, w2 bigint"


def _cells(length: int, gram: int, step: int, above: int, batches: Batches) -> Batches:
    """Every context with its keys: strings of ``length - step`` bytes around its anchor, ``step`` apart.

    Of two contexts that share ``length`` bytes around the anchor, ``l`` of them before it, both have
    the key with ``j = l // step`` in common. Taken are the keys that hold a key of the step
    ``above`` that was too frequent (``alive``).
    """
    span = length - gram
    j = np.arange(span // step if step else span + 1)
    before = j * max(step, 1)
    after = length - step - before
    parent = np.minimum(before // above, span // above - 1)
    for batch in batches:
        for low in range(0, len(batch), 1_000):
            rows = batch.slice(low, 1_000)
            contexts, lead = rows.column("context").to_pylist(), rows.column("lead").to_numpy()
            sizes = np.array([len(c) for c in contexts])
            alive = np.zeros((len(rows), span // above), bool)
            lists = rows.column("alive")
            alive[np.repeat(np.arange(len(rows)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()] = True
            fits = alive[:, parent] & (before <= lead[:, None]) & (after <= (sizes - lead)[:, None])
            row, column = np.nonzero(fits)
            if len(row):
                data = np.frombuffer(b"".join(contexts), np.uint8)
                at = (np.cumsum(sizes) - sizes + lead)[row] - before[column]
                keys = [window_hashes(data, length - step, seed)[at].view(np.int64) for seed in (11, 12)]
                columns = [rows.column("c1").to_numpy()[row], rows.column("c2").to_numpy()[row], j[column].astype(np.int32), *keys]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["c1", "c2", "j", "w1", "w2"])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def text_key(text):
    """What a text is known by: 16 bytes of its SHA-256."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)), 1, 16)


def _folded(contexts: DataFrame) -> DataFrame:
    """Each context once; equal ones of a task are folded before the shuffle."""
    one = F.first(F.struct("lead", "context")).alias("one")
    return contexts.groupBy("hash", "c1", "c2").agg(F.sum("n").alias("n"), one).select("hash", "c1", "c2", "n", "one.lead", "one.context")


def _searched(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """The contexts of each ``cell`` sorted and scanned by one task."""
    sorted_ = contexts.repartition("cell").sortWithinPartitions("cell")
    return sorted_.mapInArrow(lambda b: _group(length, gram, b), _REACHES)


def _refined(contexts: DataFrame, length: int, gram: int, group_rows: int) -> DataFrame:
    """Reaches of contexts whose anchor has too many of them for one task.

    Keys are refined step by step. What a key keeps together is scanned as soon as it is small enough;
    else it gets longer keys. Keys of ``length`` bytes need no scan: contexts that share one repeat there.
    """
    above, found = length - gram, []
    level = contexts.withColumn("alive", F.array(F.lit(0)))
    for step in steps(length - gram):
        cells = level.mapInArrow(lambda b, step=step, above=above: _cells(length, gram, step, above, b), _CELLS)
        cells = stored(cells, "repeats-cells")
        sums = stored(cells.groupBy("j", "w1", "w2").agg(F.count("*").alias("members")).where("members > 1"), "repeats-members")
        if not step:
            found.append(cells.join(sums, ["j", "w1", "w2"]).select("c1", "c2", F.col("j").alias("l"), (length - F.col("j")).alias("r")))
            break
        small = cells.join(sums.where(F.col("members") <= group_rows), ["j", "w1", "w2"]).select("c1", "c2", F.xxhash64("j", "w1", "w2").alias("cell"))
        found.append(stored(_searched(small.join(contexts, ["c1", "c2"]).select("cell", "c1", "c2", "n", "lead", "context"), length, gram), "repeats-reaches"))
        large = sums.where(F.col("members") > group_rows)
        if large.isEmpty():
            break
        alive = cells.join(large, ["j", "w1", "w2"]).groupBy("c1", "c2").agg(F.collect_list("j").alias("alive"))
        level, above = contexts.join(alive, ["c1", "c2"]), step
    # A context that occurs twice repeats as a whole.
    out = contexts.where((F.col("n") > 1) & (F.octet_length("context") >= length)).select("c1", "c2", "lead", (F.octet_length("context") - F.col("lead")).alias("r"))
    for more in found:
        out = out.unionAll(more)
    return out.groupBy("c1", "c2").agg(F.max("lead").alias("l"), F.max("r").alias("r"))


def repeats(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Rows ``(key, text)`` to the stored table ``(key, spans)`` of the texts of which something repeats.

    Equal texts are one text with a number of copies. Each string of ``length`` bytes has an anchor
    that depends on its bytes alone, so that equal strings meet at equal anchors. Anchors seen once
    are dropped before any text is moved. What stands around the others is folded where it is equal,
    in a text and beyond, and brought together by anchor; suffixes are then sorted and searched by
    interval tree. An anchor with more than ``group_rows`` different contexts is searched in
    parts, by longer keys. All but the order of work is the same at every size.
    """
    scan = stored(docs.mapInArrow(lambda b: _scan(length, gram, b), "key binary, n_bytes bigint, hashes array<bigint>, times array<int>"), "repeats-scan")
    long = scan.where(F.col("n_bytes") >= length)
    copies = long.groupBy("key").agg(F.count("*").alias("copies"), F.max("n_bytes").alias("n_bytes"), F.first(F.arrays_zip("hashes", "times")).alias("marks"))
    copies = stored(copies, "repeats-texts")
    marks = copies.select("key", F.explode("marks").alias("m")).select("key", F.col("m.hashes").alias("hash"), F.col("m.times").alias("times"))
    again = marks.groupBy("hash").agg(F.sum("times").alias("times")).where("times > 1").select("hash")
    marks = marks.join(again, "hash").groupBy("key").agg(F.collect_list("hash").alias("hashes"))
    # Of equal texts each is taken: their contexts occur twice then, and they are removed whole anyway.
    candidates = docs.where(F.octet_length("text") >= length).join(marks, "key")
    candidates = stored(candidates.select("key", "text", "hashes"), "repeats-candidates")
    places = stored(candidates.mapInArrow(lambda b: _contexts(length, gram, False, b), _PLACES), "repeats-places")
    hot = places.select("hash", "c1", "c2").distinct().groupBy("hash").count().where(F.col("count") > group_rows).select("hash")
    hot = stored(hot, "repeats-hot")
    contexts = candidates.mapInArrow(lambda b: _contexts(length, gram, True, b), _CONTEXTS)
    refine = not hot.isEmpty()
    usual = contexts.join(hot, "hash", "left_anti") if refine else contexts
    found = _searched(_folded(usual).withColumnRenamed("hash", "cell"), length, gram)
    if refine:
        many = stored(_folded(contexts.join(hot, "hash", "left_semi")), "repeats-many")
        found = found.unionAll(_refined(many, length, gram, group_rows))
    found = stored(found, "repeats-found")
    spans = places.join(found, ["c1", "c2"]).select("key", "l", "r", F.explode(F.arrays_zip("firsts", "lasts")).alias("run"))
    spans = spans.select("key", F.struct((F.col("run.firsts") - F.col("l")).alias("start"), (F.col("run.lasts") + F.col("r")).alias("stop")).alias("span"))
    spans = spans.groupBy("key").agg(F.collect_list("span").alias("spans"))
    copied = copies.where("copies > 1").select("key", F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_bytes").alias("stop"))).alias("spans"))
    return stored(spans.join(copied.select("key"), "key", "left_anti").unionAll(copied), "repeats-spans")


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the characters that lie in the spans as a whole; parts of one are kept."""
    out, at = [], 0
    for a, b in spans:
        while a < b and text[a] & 0xC0 == 0x80:
            a += 1
        while a < b < len(text) and text[b] & 0xC0 == 0x80:
            b -= 1
        out.append(text[at:a])
        at = max(at, b)
    return b"".join([*out, text[at:]])


def _spans(column: pa.Array) -> Iterator[list[tuple[int, int]]]:
    for found in column.to_pylist():
        yield merged([(s["start"], s["stop"]) for s in found or ()])


_REMOVED = "doc_id {}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<start:bigint,stop:bigint>>, kept_text string"


def remove_repeats(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH, gram: int = GRAM, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept_text)`` for every row, over whole texts as UTF-8.

    Removed is each byte that a string of ``length`` bytes covers which also starts anywhere else, in
    the same text or another; overlaps count, and all is judged on the input. ``spans`` are the
    maximal removed runs. ``kept_text`` is what is left, with the characters that are removed in part.
    Null is empty; empty and short texts lose nothing; repeated rows repeat
    each other. An empty table gives an empty result; other columns are not looked at.
    """
    docs = picked(docs, doc_id=id_column, text=text_column).withColumn("key", text_key(F.col("text")))
    found = repeats(docs.select("key", "text"), length=length, gram=gram, group_rows=group_rows)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            digests, counts, listed, kept = [], [], [], []
            for text, cut in zip(raw_bytes(batch.column("text")), _spans(batch.column("spans"))):
                digest, at = hashlib.sha256(), 0
                for a, b in cut:
                    digest.update(text[at:a])
                    at = b
                digest.update(text[at:])
                digests.append(digest.hexdigest())
                counts.append((len(text), sum(b - a for a, b in cut), len(cut)))
                listed.append([{"start": a, "stop": b} for a, b in cut])
                kept.append(without(text, cut))
            numbers = np.array(counts, np.int64).reshape(-1, 3)
            columns = [batch.column("doc_id"), *(pa.array(numbers[:, i]) for i in range(3)), pa.array(digests, pa.string())]
            columns += [pa.array(listed, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept_text"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.join(found, "key", "left").select("doc_id", "text", "spans").mapInArrow(run, _REMOVED.format(kind))


def repeats_removed(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", size_column: str | None = "n_chars", **settings) -> DataFrame:
    """The rows of ``docs`` with the repeats taken out of their text, all other columns as they were.

    Characters are removed whole, so that texts stay valid. ``size_column``, if the rows have it,
    gets the new number of characters (null stays null). Null and short texts stay as they are,
    of repeated rows each loses its whole text, an empty table gives an empty one, and no name of a
    column of ``docs`` can clash. ``id_column`` is not looked at.
    """
    columns = docs.columns
    key, spans, text = free_name(docs, "key_of_repeats"), free_name(docs, "spans_of_repeats"), F.col(f"`{text_column}`")
    found = repeats(docs.select(text_key(text).alias("key"), text.alias("text")), **settings)
    found = found.select(F.col("key").alias(key), F.col("spans").alias(spans))
    whole = docs.withColumn(key, text_key(text)).join(found, key, "left").select(*[f"`{c}`" for c in columns], spans)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            cuts = list(_spans(batch.column(spans)))
            place = columns.index(text_column)
            arrays = list(batch.columns[: len(columns)])
            if any(cuts):
                texts = batch.column(place).cast(pa.binary()).to_pylist()
                cut = [t if not c or t is None else without(t, c) for t, c in zip(texts, cuts)]
                arrays[place] = pa.array(cut, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    made = whole.mapInArrow(run, schema)
    if size_column in columns:
        kind = docs.schema[size_column].dataType
        made = made.withColumn(size_column, F.when(F.col(f"`{size_column}`").isNotNull(), F.length(text)).cast(kind))
    return made
