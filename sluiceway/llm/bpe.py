"""Byte-level BPE: a hierarchical-bitmap rank queue over linked lists, and table decoding."""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sluiceway.llm.common import Batches, Memo, picked, pieces, raw_bytes, varied

#: Texts are taken up in groups of about this many bytes, which bounds a task's memory.
GROUP_BYTES = 4 << 20
#: Words remembered per generation and task.
MEMO_WORDS = 250_000
#: New words that share a linked list and a queue.
LEARN_WORDS = 2_000
_NONE = -1


class RankQueue:
    """List positions waiting under their merge rank.

    A bucket per rank has what was known at the start, in descending order, and a heap of what came
    later, so that the leftmost position is at hand. Levels of 64-bit words mark the ranks whose
    bucket holds something; find-first-set from the top word down gives the lowest one.
    """

    def __init__(self, ranks: int):
        self.levels, size = [], max(ranks, 1)
        while not self.levels or size > 1:
            size = (size + 63) >> 6
            self.levels.append([0] * size)
        self.initial: dict[int, list[int]] = {}
        self.later: dict[int, list[int]] = {}

    def mark(self, rank: int) -> None:
        for words in self.levels:
            word = words[rank >> 6]
            words[rank >> 6] = word | 1 << (rank & 63)
            if word:
                break
            rank >>= 6

    def first(self) -> int:
        """The lowest rank with a bucket, or -1."""
        at = 0
        for words in reversed(self.levels):
            word = words[at]
            if not word:
                return _NONE
            at = at << 6 | (word & -word).bit_length() - 1
        return at

    def clear(self, rank: int) -> None:
        for words in self.levels:
            words[rank >> 6] &= ~(1 << (rank & 63))
            if words[rank >> 6]:
                break
            rank >>= 6


class Vocabulary:
    """Ranks of a tiktoken file: token bytes, and the rank that each pair of tokens merges to."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.rank = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.size = max(self.rank.values()) + 1
        self.token = [b""] * self.size
        for token, rank in self.rank.items():
            self.token[rank] = token
        self.pair = {}
        for token, rank in self.rank.items():
            for cut in range(1, len(token)):
                left, right = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if left is not None and right is not None:
                    self.pair[left << 20 | right] = rank
        self.byte = [self.rank[bytes([b])] for b in range(256)]
        self.byte_pair = np.full((256, 256), _NONE, np.int32)
        for token, rank in self.rank.items():
            if len(token) == 2:
                self.byte_pair[token[0], token[1]] = rank
        self.flat = np.frombuffer(b"".join(self.token), np.uint8)
        self.lengths = np.array([len(t) for t in self.token], np.int32)
        self.starts = np.cumsum(self.lengths, dtype=np.int32) - self.lengths
        digits = [f"{rank},".encode() for rank in range(self.size)]
        width = max(map(len, digits))
        self.digits = np.frombuffer(b"".join(d.ljust(width) for d in digits), np.uint8).reshape(-1, width)
        self.digit_used = np.arange(width) < np.array([len(d) for d in digits])[:, None]

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of each pre-token, as bytes of 32-bit integers. All lie on one linked list that has no link between two of them.

        The lowest rank goes first and, of equal ranks, the leftmost pair. An entry is stale when
        the tokens at its position no longer merge to its rank; it is skipped then.
        """
        data, n = b"".join(words), sum(map(len, words))
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        pair, queue = self.pair, RankQueue(self.size)
        token = [*map(self.byte.__getitem__, data), _NONE]
        after, before = list(range(1, n + 2)), list(range(-1, n))
        before.append(n)
        for start, end in zip((ends - lengths).tolist(), ends.tolist()):
            before[start] = n
            after[end - 1] = n
        raw = np.frombuffer(data, np.uint8)
        found = self.byte_pair[raw[:-1], raw[1:]]
        found[ends[:-1] - 1] = _NONE
        at = np.flatnonzero(found >= 0)[::-1]
        at = at[np.argsort(found[at], kind="stable")]
        ranks, places = found[at], at.tolist()
        cuts = [0, *(np.flatnonzero(np.diff(ranks)) + 1).tolist(), len(places)]
        initial, later, mark = queue.initial, queue.later, queue.mark
        if places:
            for rank, a, b in zip(ranks[cuts[:-1]].tolist(), cuts, cuts[1:]):
                initial[rank] = places[a:b]
                mark(rank)
        get, none = pair.get, []
        while (rank := queue.first()) >= 0:
            old, new = initial.get(rank, none), later.get(rank, none)
            lowest = rank
            while lowest >= rank and (old or new):
                here = heappop(new) if new and (not old or new[0] < old[-1]) else old.pop()
                right = after[here]
                if get(token[here] << 20 | token[right]) != rank:
                    continue
                token[here] = rank
                token[right] = _NONE
                beyond = after[here] = after[right]
                if beyond != n:
                    before[beyond] = here
                    if (made := get(rank << 20 | token[beyond])) is not None:
                        if made in later:
                            heappush(later[made], here)
                        else:
                            later[made] = [here]
                            mark(made)
                            if made == rank:
                                new = later[made]
                        if made < lowest:
                            lowest = made
                left = before[here]
                if left != n and (made := get(token[left] << 20 | rank)) is not None:
                    if made in later:
                        heappush(later[made], left)
                    else:
                        later[made] = [left]
                        mark(made)
                        if made == rank:
                            new = later[made]
                    if made < lowest:
                        lowest = made
            if not old and not new:
                initial.pop(rank, None)
                later.pop(rank, None)
                queue.clear(rank)
        ids = np.array(token[:n], np.int32)
        kept = ids >= 0
        stops = (np.cumsum(kept)[ends - 1] * 4).tolist()
        flat = ids[kept].tobytes()
        return [flat[a:b] for a, b in zip([0, *stops], stops)]

    def decode(self, ids: np.ndarray) -> bytes:
        return self.flat[varied(self.starts[ids], self.lengths[ids])].tobytes()

    def decimal(self, ids: np.ndarray) -> bytes:
        """The ids in decimal, joined by commas."""
        return self.digits[ids][self.digit_used[ids]].tobytes()[:-1]


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Encoder:
    """Encodes texts by way of their words, remembering a bounded number of those."""

    #: A cut before a lone blank between other characters is always one between two pre-tokens.
    _CUT = re.compile(r"(?<=\S)(?= \S)")
    _LOOSE = re.compile(r"\s\s|^\s|\s\Z")

    def __init__(self, path: str, pattern: str, memo_words: int = MEMO_WORDS):
        import regex

        self.vocabulary, self.find = vocabulary(path), regex.compile(pattern).findall
        self.known = Memo(memo_words)

    def chunks(self, text: str) -> list[str]:
        if self._LOOSE.search(text):
            return self._CUT.split(text)
        head, *rest = text.split(" ")
        return [head, *[" " + word for word in rest]]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as bytes of 32-bit integers."""
        self.known.rotate()
        cut = [self.chunks(text) for text in texts]
        unknown = self.known.missing(word for words in cut for word in words)
        for start in range(0, len(unknown), LEARN_WORDS):
            self._learn(unknown[start : start + LEARN_WORDS])
        known = self.known.young.__getitem__
        return [b"".join(map(known, words)) for words in cut]

    def _learn(self, words: list[str]) -> None:
        """Encode words. A pre-token is a word too, so one memory serves both."""
        # Letters with or without a blank before them are one pre-token.
        split = {word: self.find(word) for word in words if not word.removeprefix(" ").isalpha()}
        single = [word for word in words if word not in split]
        single += self.known.missing(token for tokens in split.values() for token in tokens)
        rank, known, merged, texts = self.vocabulary.rank, self.known.young, [], []
        for word in single:
            token = word.encode()
            if (whole := rank.get(token)) is not None:
                known[word] = whole.to_bytes(4, "little")
            else:
                merged.append(word)
                texts.append(token)
        if texts:
            known.update(zip(merged, self.vocabulary.merge(texts)))
        for word, tokens in split.items():
            if word not in known:
                known[word] = b"".join([known[token] for token in tokens])


@functools.lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def encode_batches(path: str, pattern: str, batches: Batches) -> Batches:
    """(doc_id, text) to (doc_id, ids)."""
    encoder = _encoder(path, pattern)
    for batch in batches:
        texts = raw_bytes(batch.column("text"))
        for start, end in pieces(texts, GROUP_BYTES):
            ids = encoder.encode([t.decode("utf-8", "replace") for t in texts[start:end]])
            offsets = np.cumsum([0, *[len(i) >> 2 for i in ids]]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(ids), np.int32))
            yield pa.record_batch(
                {"doc_id": batch.column("doc_id")[start:end], "ids": pa.ListArray.from_arrays(pa.array(offsets), values)}
            )


def decode_batches(path: str, batches: Batches) -> Batches:
    """(doc_id, ids) to (doc_id, ids, decoded): the bytes that the ids stand for."""
    words = vocabulary(path)
    for batch in batches:
        ids = batch.column("ids")
        flat, offsets = ids.values.to_numpy(), ids.offsets.to_numpy()
        decoded = [words.decode(flat[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        yield pa.record_batch({"doc_id": batch.column("doc_id"), "ids": ids, "decoded": pa.array(decoded, pa.binary())})


def digest_batches(path: str, batches: Batches) -> Batches:
    """(doc_id, ids, decoded) to the counts and digests that stand for them."""
    words = vocabulary(path)
    for batch in batches:
        ids = batch.column("ids")
        flat, offsets = ids.values.to_numpy(), ids.offsets.to_numpy()
        spans = list(zip(offsets[:-1].tolist(), offsets[1:].tolist()))
        yield pa.record_batch(
            {
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array([b - a for a, b in spans], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(words.decimal(flat[a:b])).hexdigest() for a, b in spans]),
                "decoded_sha256": pa.array([hashlib.sha256(d).hexdigest() for d in batch.column("decoded").to_pylist()]),
            }
        )


def encode(docs: DataFrame, path: str, pattern: str, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Token ids of whole texts: one row ``(doc_id, ids)`` per row, nothing shuffled.

    Null and empty texts have no ids. Rows with equal ids or null ids are encoded each for itself,
    an empty table gives an empty one, other columns are not looked at. ``path`` is a rank file
    that every executor can open.
    """
    docs = picked(docs, doc_id=id_column, text=text_column)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(lambda batches: encode_batches(path, pattern, batches), f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The bytes of each row of ``encode``: ``(doc_id, ids, decoded)``. Null ids decode to nothing."""
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(
        lambda batches: decode_batches(path, batches), f"doc_id {kind}, ids array<int>, decoded binary"
    )


def digests(docs: DataFrame, path: str, pattern: str, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encode and decode in one pass over the texts, keeping counts and digests only."""
    docs = picked(docs, doc_id=id_column, text=text_column)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Batches) -> Batches:
        return digest_batches(path, decode_batches(path, encode_batches(path, pattern, batches)))

    return docs.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
