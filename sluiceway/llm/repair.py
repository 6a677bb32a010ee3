"""Token ids in binary shards, compressed by a grammar of frequent pairs (Re-Pair), with random access.

A file holds one shard after another. A shard: its header of six 32-bit counts (documents, symbols,
rules, expanded ids, first nonterminal, layout version), then the rules (left, right), the length
of each rule's expansion, the document lengths, the document ids, a null mark each, and the symbols.
"""

from __future__ import annotations

import functools
import itertools
import json
import operator
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import Batches, Memo, create_file, picked, pieces, raw_bytes, read_file, stored, varied
from sluiceway.session import scratch_path

GROUP_BYTES = 4 << 20
MEMO_WORDS = 400_000
#: Ids per shard: a shard is cut after the document that reaches this.
SHARD_IDS = 1 << 20
#: A rule is stored as three numbers (its pair and the length of its expansion) and saves one with each
#: use, so it pays from the fourth on.
LEAST_COUNT = 4
#: Characters that may be composed, or have more than one lower-case form.
_UNUSUAL = re.compile("[\u0130\u0250-\U0010ffff]")
_VERSION = 1


class WordTokenizer:
    """The tokenizers library, asked once for each word and remembered.

    White space never reaches this kind of vocabulary, so a text's ids are those of its words.
    Words are normalised and split by the library's own rules, and its model tokenizes the parts.
    """

    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        import regex
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        layout = json.loads(self.library.to_str())
        self.special = [t["content"].encode() for t in layout["added_tokens"]]
        split = layout["pre_tokenizer"]["pretokenizers"][0]
        if split["type"] != "Split" or not split["invert"] or split["behavior"] != "Removed":
            raise ValueError("the tokenizer does not drop white space between words")
        self.size = self.library.get_vocab_size()
        self.find = regex.compile(split["pattern"]["Regex"]).findall
        self.letters_stay = self.find("abé") == ["abé"]  # a word of letters is then one part
        # Byte-level vocabularies write a byte as the character of its number if that is visible, else
        # as the next one from 256 on.
        visible = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
        hidden = [b for b in range(256) if b not in visible]
        self.byte_level = dict(zip(hidden, range(256, 256 + len(hidden))))
        del self.byte_level[10]  # no part holds a line break, which stands between parts
        self.words, self.parts = Memo(memo_words), Memo(memo_words)

    def encode(self, texts: list[bytes], end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, ``end`` after each, and how many of them each text has.

        Words are numbered in Arrow; each is looked up once for all its places.
        """
        self.words.rotate()
        self.parts.rotate()
        cut = pc.ascii_split_whitespace(self._lowered(pa.array(texts, pa.binary()).view(pa.string())))
        numbered = cut.flatten().dictionary_encode()
        words = _listed(numbered.dictionary)
        self._learn(self.words.missing(words))
        found = [*map(self.words.young.__getitem__, words), end]
        places = np.insert(numbered.indices.to_numpy(), cut.offsets.to_numpy()[1:], len(words))
        lengths = np.array(list(map(len, found))) // 4
        ids = np.frombuffer(b"".join(found), np.uint32)[varied((np.cumsum(lengths) - lengths)[places], lengths[places])]
        stops = cut.offsets.to_numpy() + np.arange(len(texts) + 1)  # among the places
        return ids, np.diff(np.concatenate([[0], np.cumsum(lengths[places])])[stops])

    def _lowered(self, texts: pa.Array) -> pa.Array:
        """A-Z in lower case, as the tokenizer will have it, unless that could make a special token."""
        lower = pc.ascii_lower(texts)
        found = [pc.match_substring(lower, token.decode()) for token in self.special]
        return pc.if_else(functools.reduce(pc.or_, found), texts, lower) if found else lower

    def _learn(self, words: list[bytes]) -> None:
        """Ids of words that are not known yet: each step is taken for all of them, not word by word."""
        known, ids = self.words.young, self.parts.young
        together = b"\n".join(words)
        if any(token in together for token in self.special):
            special = [raw for raw in words if any(token in raw for token in self.special)]
            for raw in special:
                found = self.library.encode(raw.decode("utf-8", "replace"), add_special_tokens=False).ids
                known[raw] = array("I", found).tobytes()
            words = [raw for raw in words if raw not in known]
            together = b"\n".join(words)
        if not words:
            return
        normal = self._normalized(together.decode("utf-8", "replace"))
        alone = [self.letters_stay and word.isalpha() for word in normal]
        cut = list(map(self.find, itertools.compress(normal, map(operator.not_, alone))))
        self._learn_parts(self.parts.missing(itertools.chain.from_iterable([itertools.compress(normal, alone), *cut])))
        rest = iter(cut)
        for raw, word, whole in zip(words, normal, alone):
            known[raw] = ids[word] if whole else b"".join([ids[part] for part in next(rest)])

    def _normalized(self, lines: str) -> list[str]:
        if not _UNUSUAL.search(lines):
            return lines.lower().split("\n")  # Latin letters are composed already, and each has one lower-case form
        normalize = self.library.normalizer.normalize_str
        return [normalize(word) if _UNUSUAL.search(word) else word.lower() for word in lines.split("\n")]

    def _learn_parts(self, parts: list[str]) -> None:
        ids, tokenize = self.parts.young, self.library.model.tokenize
        hidden = [part for part in parts if not (part.isascii() and part.isprintable())]
        mapped = dict(zip(hidden, "\n".join(hidden).encode().decode("latin-1").translate(self.byte_level).split("\n")))
        for part in parts:
            ids[part] = array("I", [token.id for token in tokenize(mapped.get(part, part))]).tobytes()


def _listed(words: pa.Array) -> list[bytes]:
    """Words, none of which holds a line break; much faster than one by one."""
    together = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), "\n")
    return together[0].as_buffer().to_pybytes().split(b"\n")[: len(words)]


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def _chosen(place: np.ndarray, after: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Of pairs at ascending places, with the place of their right half, those to replace: none overlaps another.

    Of two that overlap it is the more frequent one; in a chain of equals, every other one.
    """
    beside = place[1:] == after[:-1]
    more, less = weight[1:] > weight[:-1], weight[1:] < weight[:-1]
    number = np.arange(len(place))
    start = number.copy()  # of its chain
    start[1:][beside & ~(more | less)] = 0
    take = (number - np.maximum.accumulate(start)) & 1 == 0
    take[1:] &= ~(beside & less)
    take[:-1] &= ~(beside & more)
    return take


def _frequent(pairs: np.ndarray, width: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(kinds, counts, which): the pairs found ``least`` times or more in order, and for each pair its kind or -1.

    Sorting numbers is much cheaper than sorting their places by them, so a number holds a pair (of
    ``width`` bits) and its place, where both fit into one.
    """
    bits = len(pairs).bit_length()
    if width + bits < 64:
        ordered = np.sort(pairs << bits | np.arange(len(pairs)))
        place = ordered & (1 << bits) - 1
        ordered >>= bits
    else:
        place = np.argsort(pairs, kind="stable")
        ordered = pairs[place]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    counts = np.diff(np.append(starts, len(ordered)))
    often = np.flatnonzero(counts >= least)
    numbers = np.full(len(starts), -1)
    numbers[often] = np.arange(len(often))
    which = np.empty(len(pairs), np.int64)
    which[place] = np.repeat(numbers, counts)
    return ordered[starts[often]], counts[often], which


def compress(ids: np.ndarray, first: int, least: int = LEAST_COUNT) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, rules): symbols from ``first`` on stand for the pairs in ``rules``.

    Each round counts pairs and gives a nonterminal to those that it can replace ``least`` times or
    more, until there are none. After the first round only pairs that hold a new symbol or were
    frequent before can be frequent, so only their places are looked at again. Symbols that went are
    skipped by links to the next and the previous one.
    """
    symbols, rules, made, n = ids.astype(np.int64), [], 0, len(ids)
    following, before, alive = np.arange(1, n + 1), np.arange(-1, n - 1), np.ones(n, bool)
    place = np.arange(n - 1)
    while len(place):
        bits = (first + made).bit_length()
        pairs = symbols[place] << bits | symbols[following[place]]
        kinds, counts, which = _frequent(pairs, 2 * bits, least)
        kept = np.flatnonzero(which >= 0)
        if not len(kept):
            break
        place, which = place[kept], which[kept]
        take = _chosen(place, following[place], counts[which])
        pays = np.flatnonzero(np.bincount(which[take], minlength=len(kinds)) >= least)
        if not len(pays):
            break
        number = np.zeros(len(kinds), np.int64)
        number[pays] = np.arange(first + made, first + made + len(pays))
        new = number[which]
        taken = np.flatnonzero(take & (new > 0))
        at = place[taken]
        symbols[at] = new[taken]
        gone = following[at]
        alive[gone] = False
        after = following[gone]
        following[at] = after
        linked = np.flatnonzero(after < n)
        before[after[linked]] = at[linked]
        rules.append(np.stack([kinds[pays] >> bits, kinds[pays] & (1 << bits) - 1], 1).astype(np.uint32))
        made += len(pays)
        again = np.zeros(n + 1, bool)  # one more, for what would come before the first
        again[place] = True
        again[before[at]] = True
        again[gone] = again[n] = False
        place = np.flatnonzero(again)
        place = place[following[place] < n]
    return symbols[alive].astype(np.uint32), np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)


def expansions(rules: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, starts, lengths) of what each symbol stands for, the plain ids first."""
    plain = np.arange(first, dtype=np.uint32).tobytes()
    parts: list[bytes] = []
    for left, right in rules.tolist():
        head = parts[left - first] if left >= first else plain[4 * left : 4 * left + 4]
        parts.append(head + (parts[right - first] if right >= first else plain[4 * right : 4 * right + 4]))
    lengths = np.concatenate([np.ones(first, np.int64), np.array([len(p) // 4 for p in parts], np.int64)])
    return np.frombuffer(b"".join([plain, *parts]), np.uint32), np.cumsum(lengths) - lengths, lengths


def rule_lengths(rules: np.ndarray, first: int) -> np.ndarray:
    """How many ids each rule stands for."""
    found: list[int] = []
    for left, right in rules.tolist():
        found.append((found[left - first] if left >= first else 1) + (found[right - first] if right >= first else 1))
    return np.array(found, np.uint32)


class Shard:
    """One shard read back; any range of its ids can be had without expanding the rest."""

    def __init__(self, data: bytes, at: int):
        head = np.frombuffer(data, np.uint32, 6, at)
        docs, symbols, rules, self.n_ids, self.first, version = map(int, head)
        if version != _VERSION:
            raise ValueError(f"layout {version} is not known")
        at += head.nbytes
        parts = []
        for kind, n in ((np.uint32, 2 * rules), (np.uint32, rules), (np.uint32, docs), (np.int64, docs), (np.uint8, docs), (np.uint32, symbols)):
            parts.append(np.frombuffer(data, kind, n, at))
            at += parts[-1].nbytes
        self.rules, self.rule_lengths, self.doc_lengths, self.doc_ids, self.doc_null, self.symbols = parts
        self.end = at
        self.flat, self.starts, self.lengths = expansions(self.rules.reshape(-1, 2), self.first)
        self.ends = np.cumsum(self.lengths[self.symbols])

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the shard."""
        if start >= stop:
            return np.zeros(0, np.uint32)
        a, b = np.searchsorted(self.ends, [start, stop - 1], "right")
        part = self.symbols[a : b + 1]
        ids = self.flat[varied(self.starts[part], self.lengths[part])]
        skip = start - (int(self.ends[a - 1]) if a else 0)
        return ids[skip : skip + stop - start]


def pack(doc_ids: list, lengths: list[int], ids: np.ndarray, first: int) -> bytes:
    symbols, rules = compress(ids, first)
    head = np.array([len(doc_ids), len(symbols), len(rules), len(ids), first, _VERSION], np.uint32)
    marks = np.array([d is None for d in doc_ids], np.uint8)
    numbers = np.array([0 if d is None else d for d in doc_ids], np.int64)
    parts = (head, rules, rule_lengths(rules, first), np.array(lengths, np.uint32), numbers, marks, symbols)
    return b"".join(p.tobytes() for p in parts)


def shards_of(data: bytes) -> Iterator[Shard]:
    at = 0
    while at < len(data):
        yield (shard := Shard(data, at))
        at = shard.end


def write_batches(path: str, end_id: int, folder: str, shard_ids: int, batches: Batches) -> Batches:
    """(doc_id, text) in order to one file of shards; returns where it is and what it holds."""
    task, tokenizer = TaskContext.get(), _tokenizer(path)
    name = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}.ids"
    end, first = np.array([end_id], np.uint32).tobytes(), max(tokenizer.size, end_id + 1)
    file, docs, total = None, 0, 0
    doc_ids, parts, lengths, held = [], [], [], 0

    def flush() -> None:
        nonlocal doc_ids, parts, lengths, held, docs, total
        file.write(pack(doc_ids, lengths, np.concatenate(parts), first))
        docs, total = docs + len(doc_ids), total + held
        doc_ids, parts, lengths, held = [], [], [], 0

    for batch in batches:
        texts, keys = raw_bytes(batch.column("text")), batch.column("doc_id").to_pylist()
        for a, b in pieces(texts, GROUP_BYTES):
            file = file or create_file(name)
            ids, sizes = tokenizer.encode(texts[a:b], end)
            for key, size, stop in zip(keys[a:b], sizes.tolist(), np.cumsum(sizes).tolist()):
                doc_ids.append(key)
                parts.append(ids[stop - size : stop])
                lengths.append(size)
                held += size
                if held >= shard_ids:
                    flush()
    if file:
        if doc_ids:
            flush()
        file.close()
        yield pa.record_batch({"part": pa.array([task.partitionId()]), "path": [name], "docs": [docs], "ids": [total]}, schema=_INDEX)


_INDEX = pa.schema([("part", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())])
_ROWS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def read_batches(batches: Batches) -> Batches:
    """(path, base) to a row per document of the file, its ids expanded and summed up."""
    for batch in batches:
        for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
            for shard in shards_of(read_file(path)):
                stops = np.cumsum(shard.doc_lengths, dtype=np.int64)
                ids = shard.ids(0, shard.n_ids)
                begins = stops - shard.doc_lengths
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(begins.tolist(), stops.tolist())]
                yield pa.record_batch(
                    {
                        "doc_id": pa.array(shard.doc_ids, mask=shard.doc_null.astype(bool)),
                        "start": pa.array(base + begins),
                        "n_tokens": pa.array(shard.doc_lengths.astype(np.int64)),
                        "ids_crc32": pa.array(sums, pa.int64()),
                    }
                )
                base += shard.n_ids


def write_ids(
    docs: DataFrame, tokenizer: str, *, end_id: int = 2, id_column: str = "doc_id", text_column: str = "text",
    shard_ids: int = SHARD_IDS, folder: str | None = None,
) -> DataFrame:
    """Write token ids in ascending ``doc_id`` order; one row ``(part, path, docs, ids)`` per file.

    Null ids come first; rows with equal ids follow each other by a hash of their text, so the order
    and the files' contents are the same in every run. Null and empty texts hold the end id alone.
    The order is made by range partitions that split a frequent id, too. Each attempt of a task
    writes a file of its own; only the ones named by the returned (stored) table count. An empty
    table writes nothing. Other columns are not looked at.
    """
    folder = folder or scratch_path(docs.sparkSession, "ids")
    docs = picked(docs, doc_id=id_column, text=text_column).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    placed = docs.repartitionByRange(*order).sortWithinPartitions(*order)
    written = placed.mapInArrow(
        lambda batches: write_batches(tokenizer, end_id, folder, shard_ids, batches), "part int, path string, docs bigint, ids bigint"
    )
    return stored(written, "ids-index")


def read_ids(index: DataFrame) -> DataFrame:
    """One row ``(doc_id, start, n_tokens, ids_crc32)`` per document, read from the files of ``write_ids``.

    The driver sees one row per file, to add up where each begins. Null ids come last and are read back as null,
    documents without ids have the end id alone, repeated rows come as often as they were written, and
    without files the result is empty.
    """
    spark, base, rows = index.sparkSession, 0, []
    for row in index.orderBy("part").collect():
        rows.append((row.part, row.path, base))
        base += row.ids
    files = spark.createDataFrame(rows, "part int, path string, base bigint")
    if rows:
        files = files.repartitionByRange(len(rows), "part")
    return files.mapInArrow(read_batches, _ROWS)
