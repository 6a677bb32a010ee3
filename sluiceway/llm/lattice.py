"""Language-model scores of whole texts: counted words, and the likelihood of all subword segmentations."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import Batches, packed, picked, raw_bytes, stored, unpacked

#: Passes over the training words that fit the pieces' probabilities.
ROUNDS = 2
#: What the vocabulary's own scores weigh in the fit, in pieces.
PRIOR = 1_000.0
#: Probability that a token beyond all counts is the end of a text.
UNSEEN_END = 1 / 1024
#: Bytes of words whose lattices are held at once; a longer word is gone through in windows of it.
WINDOW = 1 << 16
#: Fractions of expected counts are kept to this unit, so that sums do not depend on their order.
UNIT = 1 << 24


def vocabulary(path: str) -> tuple[list[bytes], np.ndarray]:
    """The pieces of a sentencepiece file as bytes, word starts as a blank, and what they weigh (sum 1).

    Scores of merge files are ranks from 0 down; a piece then weighs the inverse of its rank. Other
    scores are logarithms. Single bytes, which spell what no piece does, come last.
    """
    import sentencepiece

    file = sentencepiece.SentencePieceProcessor(model_file=path)
    places = [i for i in range(file.get_piece_size()) if not (file.is_control(i) or file.is_unknown(i) or file.is_unused(i))]
    score: dict[bytes, float] = {}
    for i in places:
        if not file.is_byte(i):
            piece = file.id_to_piece(i).replace("▁", " ").encode()
            if b" " not in piece[1:]:
                score[piece] = max(file.get_score(i), score.get(piece, -math.inf))
    values = np.array(list(score.values()))
    ranks = bool((values == np.rint(values)).all())
    values = 1 / (10 - values) if ranks else np.exp(values)
    rest = [bytes([b]) for b in range(256) if bytes([b]) not in score]
    values = np.append(values, np.full(len(rest), values.min()))
    return [*score, *rest], values / values.sum()


class Trie:
    """Pieces as a tree of bytes in sorted arrays, walked from many places at once."""

    def __init__(self, pieces: list[bytes]):
        edges, ends = {}, [-1]
        for number, piece in enumerate(pieces):
            node = 0
            for byte in piece:
                node = edges.setdefault(node << 8 | byte, len(ends))
                if node == len(ends):
                    ends.append(-1)
            ends[node] = number
        self.keys = np.array(sorted(edges), np.int64)
        self.child = np.array([edges[k] for k in self.keys.tolist()], np.int64)
        self.piece = np.array(ends, np.int32)

    def arcs(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, piece) of every piece that begins at one of ``starts`` and ends by its stop."""
        at, stop, node, depth = starts, stops, np.zeros(len(starts), np.int64), 0
        found: list[tuple] = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32))]
        while len(at):
            alive = at + depth < stop
            at, stop, node = at[alive], stop[alive], node[alive]
            key = node << 8 | data[at + depth]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            alive = self.keys[edge] == key
            at, stop, node, depth = at[alive], stop[alive], self.child[edge[alive]], depth + 1
            piece = self.piece[node]
            ends = piece >= 0
            found.append((at[ends], at[ends] + depth, piece[ends]))
        return tuple(np.concatenate(c) for c in zip(*found))


class Lattice:
    """All segmentations of some words. A word is a blank and its bytes; one more place is its end."""

    def __init__(self, trie: Trie, words: list[bytes], window: int = WINDOW):
        self.trie, self.window = trie, window
        sizes = np.array([len(w) + 2 for w in words], np.int64)
        self.ends = np.cumsum(sizes) - 1
        self.first = self.ends + 1 - sizes
        self.data = np.frombuffer(b"".join(b" " + w + b"\0" for w in words), np.uint8).astype(np.int64)
        self.word = np.repeat(np.arange(len(words)), sizes)
        self.kept: tuple | None = None

    def _arcs(self, low: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces that begin in a window; of the only window they are kept."""
        if self.kept is not None:
            return self.kept
        starts = np.arange(low, min(low + self.window, len(self.data)))
        found = self.trie.arcs(self.data, starts, self.ends[self.word[starts]])
        if len(self.data) <= self.window:
            self.kept = found
        return found

    @staticmethod
    def _waves(key: np.ndarray, place: np.ndarray):
        """Arcs in waves of equal ``key``, and in those by ``place``: (order, group starts, group places)."""
        order = np.lexsort((place, key))
        key, place = key[order], place[order]
        group = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(place) else np.zeros(0, np.int64)
        wave = np.flatnonzero(np.concatenate([[True], key[group][1:] != key[group][:-1]])) if len(group) else group
        for a, b in zip(wave.tolist(), [*wave[1:].tolist(), len(group)]):
            low, high = group[a], group[b] if b < len(group) else len(order)
            yield order[low:high], group[a:b] - low, place[group[a:b]]

    def forward(self, scores: np.ndarray) -> np.ndarray:
        """Log of the summed probability of all ways to each place."""
        sums = np.full(len(self.data), -np.inf)
        sums[self.first] = 0.0
        for low in range(0, len(self.data), self.window):
            start, end, piece = self._arcs(low)
            for order, groups, places in self._waves(end - self.first[self.word[end]], end):
                ways = np.logaddexp.reduceat(sums[start[order]] + scores[piece[order]], groups)
                sums[places] = np.logaddexp(sums[places], ways)
        return sums

    def expected(self, scores: np.ndarray) -> np.ndarray:
        """How often each piece is used on average over all segmentations, in units, summed over the words."""
        before = self.forward(scores)
        total, after = before[self.ends], np.full(len(self.data), -np.inf)
        after[self.ends] = 0.0
        used = np.zeros(len(scores))
        for low in reversed(range(0, len(self.data), self.window)):
            start, end, piece = self._arcs(low)
            for order, groups, places in self._waves(self.first[self.word[start]] - start, start):
                after[places] = np.logaddexp.reduceat(after[end[order]] + scores[piece[order]], groups)
            share = np.exp(before[start] + scores[piece] + after[end] - total[self.word[start]])
            used += np.bincount(piece, np.rint(share * UNIT), len(scores))
        return used.astype(np.int64)


def _lattices(trie: Trie, words: list[bytes], window: int):
    """Lattices of about a window's bytes each, words of like length together: (places of the words, lattice)."""
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    low = size = 0
    for k, i in enumerate(order):
        if size and size + len(words[i]) + 2 > window:
            yield order[low:k], Lattice(trie, [words[j] for j in order[low:k]], window)
            low, size = k, 0
        size += len(words[i]) + 2
    if order:
        yield order[low:], Lattice(trie, [words[j] for j in order[low:]], window)


def _distinct(texts: list[bytes]) -> tuple[list[bytes], list[list[int]]]:
    """The words of lower-cased texts, and each text as their numbers."""
    number: dict[bytes, int] = {}
    seen = number.setdefault
    cut = [[seen(w, len(number)) for w in text.lower().split()] for text in texts]
    return list(number), cut


def word_counts(texts: DataFrame) -> DataFrame:
    """Rows with ``text`` to ``(word, n)``; a batch of texts sends each of its words once."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            words, cut = _distinct(raw_bytes(batch.column("text")))
            n = np.zeros(len(words), np.int64)
            for ids in cut:
                n += np.bincount(ids, minlength=len(words)) if len(ids) * 8 > len(words) else 0
                if len(ids) * 8 <= len(words):
                    np.add.at(n, ids, 1)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(n)], names=["word", "n"])

    return texts.select("text").mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Counts of all training words as a table; the rest is bounded by the vocabulary of pieces."""

    counts: DataFrame
    trie: Trie
    scores: np.ndarray  # of the pieces: natural logarithms
    stop: float  # of the end of a spelled word
    ends: int
    tokens: int
    kinds: int
    discount: float


def learn(docs: DataFrame, vocabulary_file: str, *, text_column: str = "text", rounds: int = ROUNDS) -> Model:
    """A model of words and of how words are spelled, from all whole texts.

    Words are counted, the end of a text as one. From every count a discount is taken, and what that
    gives goes to the spelling model: a word is a sequence of vocabulary pieces, drawn one after
    another, and its probability the sum over all such sequences. The pieces' probabilities begin as
    the vocabulary's own scores and are fitted to the training words, each once, by expected counts.
    """
    texts = picked(docs, text=text_column)
    counts = stored(word_counts(texts), "lattice-counts")
    ends = texts.count()
    said = counts.agg(F.count("*"), F.sum("n"), F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)).first()
    kinds, tokens, once, twice = (v or 0 for v in said)
    pieces, prior = vocabulary(vocabulary_file)
    trie, scores, stop = Trie(pieces), np.log(prior), math.log(0.25)
    for _ in range(rounds if kinds else 0):
        used = _expected(counts, trie, scores)
        whole = used.sum() + PRIOR + kinds + 1
        scores, stop = np.log((used + PRIOR * prior) / whole), math.log((kinds + 1) / whole)
    # Of Good and Turing: words seen once tell how much unseen ones weigh.
    discount = (once + 1) / (once + 2 * twice + 2)
    return Model(counts, trie, scores, stop, ends, tokens + ends, kinds + bool(ends), discount)


def _expected(counts: DataFrame, trie: Trie, scores: np.ndarray) -> np.ndarray:
    """Expected uses of every piece over the words, each once. A row per piece reaches the driver."""

    def run(batches: Batches) -> Batches:
        used = np.zeros(len(scores), np.int64)
        for batch in batches:
            for _, lattice in _lattices(trie, batch.column("word").to_pylist(), WINDOW):
                used += lattice.expected(scores)
        hit = np.flatnonzero(used)
        yield pa.RecordBatch.from_arrays([pa.array(hit.astype(np.int32)), pa.array(used[hit])], names=["piece", "n"])

    out = np.zeros(len(scores))
    for row in counts.select("word").mapInArrow(run, "piece int, n bigint").groupBy("piece").agg(F.sum("n").alias("n")).collect():
        out[row.piece] = row.n / UNIT
    return out


_BLOCK = "block bigint, doc_id array<{}>, held array<boolean>, sizes array<int>, ids binary, words array<binary>"


def _blocks(batches: Batches) -> Batches:
    """Each batch of texts as one row: its words once, and the texts as their numbers."""
    task = TaskContext.get().partitionId()
    for place, batch in enumerate(batches):
        words, cut = _distinct(raw_bytes(batch.column("text")))
        ids = np.fromiter((i for text in cut for i in text), np.int32, sum(map(len, cut)))
        whole = [0, len(batch)]
        lists = [pa.ListArray.from_arrays(whole, batch.column(c)) for c in ("doc_id", "held")]
        sizes = pa.ListArray.from_arrays(whole, pa.array([len(t) for t in cut], pa.int32()))
        columns = [pa.array([task << 32 | place]), *lists, sizes, pa.array([packed(ids)], pa.binary()), pa.array([words], pa.list_(pa.binary()))]
        yield pa.RecordBatch.from_arrays(columns, names=["block", "doc_id", "held", "sizes", "ids", "words"])


def _spelled(trie: Trie, scores: np.ndarray, window: int, batches: Batches) -> Batches:
    for batch in batches:
        words = batch.column("word").to_pylist()
        found = np.zeros(len(words))
        for places, lattice in _lattices(trie, words, window):
            found[places] = lattice.forward(scores)[lattice.ends]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=["word", "n", "spelled"])


def token_scores(n: np.ndarray, spelled: np.ndarray, model: Model) -> np.ndarray:
    """Log10 probability of words seen ``n`` times, of which all segmentations together have ``spelled``."""
    rest = math.log(model.discount * model.kinds + 1)
    with np.errstate(divide="ignore"):
        counted = np.log(np.maximum(n - model.discount, 0))
    either = np.logaddexp(counted, rest + math.log1p(-UNSEEN_END) + spelled + model.stop)
    return (either - math.log(model.tokens + 1)) / math.log(10)


def end_score(model: Model) -> float:
    rest = (model.discount * model.kinds + 1) * UNSEEN_END
    return math.log10((max(model.ends - model.discount, 0) + rest) / (model.tokens + 1))


def _base(n, model: Model):
    return np.log10((n + 0.5) / (model.tokens + 0.5 * (model.kinds + 1)))


def _scored(model: Model, batches: Batches) -> Batches:
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    for batch in batches:
        for row in range(len(batch)):
            one = batch.slice(row, 1)
            found = one.column("found").flatten()
            place = found.field("place").to_numpy()
            n, spelled = np.zeros(len(place), np.int64), np.zeros(len(place))
            n[place], spelled[place] = found.field("n").to_numpy(), found.field("spelled").to_numpy()
            ids = unpacked(one.column("ids")[0].as_py())
            sizes = one.column("sizes").flatten().to_numpy().astype(np.int64)
            some = np.flatnonzero(sizes)
            starts = (np.cumsum(sizes) - sizes)[some]
            sums = []
            for values in ((n > 0).astype(np.int64), _base(n, model), token_scores(n, spelled, model)):
                out = np.zeros(len(sizes), values.dtype)
                if len(some):
                    out[some] = np.add.reduceat(values[ids], starts)
                sums.append(out)
            columns = [
                one.column("doc_id").flatten(), one.column("held").flatten(), pa.array(sizes + 1), pa.array(sums[0] + bool(model.ends)),
                pa.array(np.full(len(sizes), model.tokens)), pa.array(sums[1] + _base(model.ends, model)), pa.array(sums[2] + end_score(model)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def score(docs: DataFrame, model: Model, held_out: Column, *, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every row, over whole texts.

    A text is its words in lower case (A-Z) and one end. ``score`` is the model's log10 probability of
    these; ``base_score`` that of counted words alone, smoothed by a half; ``n_known`` tokens occur in
    training. Null and empty texts are an end alone. Repeated rows and ids are scored each for itself;
    an empty table gives an empty result; a null ``held_out`` is false; other columns are not looked at.

    The distinct words of a block of texts meet the counts by a join, so that no task holds more words
    than its texts do, and the lattice of a word is gone through once, however often it occurs.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").alias("text"), F.coalesce(held_out, F.lit(False)).alias("held"))
    blocks = stored(rows.mapInArrow(_blocks, _BLOCK.format(kind)), "lattice-blocks")
    words = blocks.select("block", F.posexplode("words").alias("place", "word"))
    kinds = words.select("word").distinct().join(model.counts, "word", "left").select("word", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
    trie, scores = model.trie, model.scores
    kinds = stored(kinds.mapInArrow(lambda b: _spelled(trie, scores, window, b), "word binary, n bigint, spelled double"), "lattice-words")
    found = words.join(kinds, "word").groupBy("block").agg(F.collect_list(F.struct("place", "n", "spelled")).alias("found"))
    none = F.array().cast("array<struct<place:int,n:bigint,spelled:double>>")
    joined = blocks.drop("words").join(found, "block", "left").withColumn("found", F.coalesce("found", none))
    slim = Model(None, None, None, model.stop, model.ends, model.tokens, model.kinds, model.discount)
    schema = f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return joined.mapInArrow(lambda b: _scored(slim, b), schema)
