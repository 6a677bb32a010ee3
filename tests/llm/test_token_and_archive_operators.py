"""Tokens, archives, url rules and neighbours: exact round trips and brute force."""

import base64
import hashlib
import io
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluiceway.llm import bpe, queries, repair, urls, vptree, warc

BITS = ["a", "b", " ", "  ", "\n", "é", "日本", "'s", "1", "23", "!", "\x1c", "\u2003", "\t", "x", "the", "\r\n", "😀", "\u0301", "İ", "ΑΣ", "<|endoftext|>"]


def texts_of(seed, n=400):
    draw = random.Random(seed)
    made = ["".join(draw.choices(BITS, k=draw.randint(0, 60))) for _ in range(n)]
    return [*made, None, "", "a" * 5000, "ab" * 3000, " " * 300, "\n\n x", "".join(draw.choices("abc", k=20_000)), made[0]]


def frame(spark, texts):
    return spark.createDataFrame([(i if i % 50 else None, t, 1, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, ids int, decoded string")


def test_bpe_equals_the_library(spark):
    import tiktoken

    path, pattern, texts = queries.vocabulary_file(queries.BYTE_BPE), queries.pre_token_pattern(), texts_of(1)
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    docs = frame(spark, texts)
    found = bpe.decode(bpe.encode(docs, path, pattern), path).collect()
    assert [r.ids for r in found] == [library.encode_ordinary(t or "") for t in texts]
    assert [bytes(r.decoded).decode() for r in found] == [t or "" for t in texts]
    for r, ids, text in zip(bpe.digests(docs, path, pattern).collect(), [r.ids for r in found], texts):
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.digests(docs.limit(0), path, pattern).count() == 0


def test_bpe_of_texts_that_begin_with_an_apostrophe():
    import tiktoken

    path, pattern = queries.vocabulary_file(queries.BYTE_BPE), queries.pre_token_pattern()
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    texts = ["'Some words", "'Der Rest", "'venir ici", "'s", "(The end", "1st", "\tThe", "Some 'Some", "é", " a", "\u2003The"]
    found = bpe.Encoder(path, pattern).encode(texts)
    assert [np.frombuffer(ids, np.int32).tolist() for ids in found] == [library.encode_ordinary(t) for t in texts]


def test_rank_queue_finds_the_lowest():
    queue, draw = bpe.RankQueue(50_000), random.Random(3)
    held = {draw.randrange(50_000) for _ in range(500)}
    for rank in held:
        queue.mark(rank)
    out = []
    while (rank := queue.first()) >= 0:
        out.append(rank)
        queue.clear(rank)
    assert out == sorted(held)


def test_token_files(spark, tmp_path):
    import tokenizers

    path, texts = queries.vocabulary_file(queries.WORD_BPE), texts_of(2)
    library = tokenizers.Tokenizer.from_file(path)
    docs = frame(spark, texts)
    index = repair.write_ids(docs, path, shard_ids=2000, folder=str(tmp_path / "ids"))
    found = repair.read_ids(index).orderBy("start").collect()
    want = []
    for row in docs.select("*", F.xxhash64("text").alias("h")).collect():
        ids = [*library.encode(row.text or "", add_special_tokens=False).ids, 2]
        want.append((row.doc_id is not None, row.doc_id or 0, row.h, ids))
    start = 0
    for row, (known, doc, _, ids) in zip(found, sorted(want), strict=True):
        assert (row.doc_id, row.start, row.n_tokens) == (doc if known else None, start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert repair.read_ids(repair.write_ids(docs.limit(0), path)).count() == 0


def test_words_are_looked_up_once_for_all_their_places():
    class Counted(dict):
        asked = 0

        def __getitem__(self, key):
            self.asked += 1
            return super().__getitem__(key)

    tokenizer = repair.WordTokenizer(queries.vocabulary_file(queries.WORD_BPE))
    tokenizer.words.young = counted = Counted()
    texts = ["  two words, two Words \t\x0b", "", " ", "words " * 5000 + "<|endoftext|>", "\n", "x<|endoftext|>Y <|EndOfText|> \u0130\u03a3 e\u0301 a\u00a0b \x00\x1f it's 12", "two"]
    ids, sizes = tokenizer.encode([text.encode() for text in texts], np.array([2], np.uint32).tobytes())
    want = [[*tokenizer.library.encode(text, add_special_tokens=False).ids, 2] for text in texts]
    assert sizes.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])
    assert counted.asked < 30
    again, _ = tokenizer.encode([b"two", b"two new words"])
    assert again.tolist() == sum((tokenizer.library.encode(text, add_special_tokens=False).ids for text in ("two", "two new words")), [])


def test_frequent_pairs_are_the_same_however_they_are_sorted():
    pairs = np.random.default_rng(2).integers(0, 300, 2000)
    narrow, wide = repair._frequent(pairs, 9, 7), repair._frequent(pairs, 62, 7)
    for a, b in zip(narrow, wide, strict=True):
        assert np.array_equal(a, b)
    kinds, counts = np.unique(pairs, return_counts=True)
    assert np.array_equal(narrow[0], kinds[counts >= 7]) and np.array_equal(narrow[1], counts[counts >= 7])
    assert np.array_equal(narrow[2], [list(narrow[0]).index(p) if p in narrow[0] else -1 for p in pairs])


def test_grammar_round_trip_and_random_access():
    draw = np.random.default_rng(1)
    phrases = draw.integers(0, 100, (20, 6))
    ids = np.concatenate([phrases[i] for i in draw.integers(0, 20, 3000)] + [np.full(999, 7)]).astype(np.uint32)
    symbols, rules = repair.compress(ids, 100)
    assert len(symbols) < len(ids) / 2 and len(rules)
    shard = repair.Shard(repair.pack([None, 4], [1000, len(ids) - 1000], ids, 100), 0)
    assert np.array_equal(shard.ids(0, len(ids)), ids)
    for a, b in draw.integers(0, len(ids), (200, 2)).tolist():
        assert np.array_equal(shard.ids(a, b), ids[a:b])
    assert shard.rule_lengths.tolist() == [len(shard.flat[s : s + n]) for s, n in zip(shard.starts[100:], shard.lengths[100:])]
    assert len(repair.compress(np.zeros(0, np.uint32), 100)[0]) == 0


@pytest.mark.parametrize("least_bytes", [0, 3])
def test_archives(spark, least_bytes):
    pages = [(1, "http://a", "same"), (2, "http://b\r\nX: y", "same"), (5, None, "same"), (3, "u", None), (4, "u", ""), (None, "u", "same"),
             (None, "u", "alone"), (6, "u", "é\r\n\r\nx"), (7, "u", "twice"), (7, "u", "twice"), (8, "u", "q" * 400_000), (9, "u", "ab"), (10, "u", "ab")]
    table = spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("digest", F.lit("clash"))
    found = warc.read_warc(warc.write_warc(table, least_bytes=least_bytes, frame_bytes=300)).collect()
    want = []
    for page, _, html in pages:
        payload = (html or "").encode()
        ids = [p for p, _, h in pages if (h or "") == (html or "") and p is not None]
        first = max(ids) if ids and len(payload) >= least_bytes else None
        refers = first if first is not None and page != first else None
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        want.append((page, len(payload), digest, "response" if refers is None else "revisit", refers))
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
    assert warc.read_warc(warc.write_warc(table.limit(0))).count() == 0


def test_bundles_are_plain_zstandard_and_seekable():
    import zstandard

    class Kept(io.BytesIO):
        def close(self):
            self.held = self.getvalue()

    file = Kept()
    writer, records = warc.Writer(file, 100), {f"<r{i}>": b"%d " % i * i for i in range(60)}
    for name, data in records.items():
        writer.add(name, data)
    writer.close()
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(file.held), read_across_frames=True).read()
    assert whole == b"".join(records.values())
    bundle = warc.Bundle(io.BytesIO(file.held))
    assert len(bundle.frames) > 5
    assert all(bundle.get(name) == data for name, data in records.items())


def test_url_rules(spark):
    rules = [*queries.URL_RULES, ("a.b/x/", "block"), ("b/x/y", "allow"), ("b/x/y", "block"), ("nohost", "block"), (None, "block"), ("c/", "odd")]
    hosts = ["net", "x.net", "Example.NET", "example.com", "m.example.com", "org", "a.b", "b", "notnet", "", "c", "u@x.net:80"]
    addresses = [f"http://{h}{p}" for h in hosts for p in ("", "/", "/en/x", "/de/", "/fr/?q", "/x/y#z", "/x/", "?/en/", "/EN/")]
    addresses += [None, "", "no scheme", "://", "a://b://c/x/", "http://NET/\n/x"]
    pages = spark.createDataFrame(list(enumerate(addresses)), "page_id bigint, url string").withColumn("host", F.lit("clash"))
    array = urls.build(spark.createDataFrame(rules, "rule string, verdict string"))
    found = {r.page_id: r for r in urls.judge(pages, array).collect()}
    usable = {r: v for r, v in sorted((r for r in rules if r[0] and "/" in r[0] and r[1] != "odd"))}
    for i, address in enumerate(addresses):
        rest = (address or "").partition("://")[2]
        cut = min((rest + "#").index(c) for c in "/?#" if c in rest + "#")
        host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
        fits = []
        for rule in usable:
            rule_host, _, rule_path = rule.partition("/")
            if (host == rule_host or host.endswith("." + rule_host)) and path.startswith("/" + rule_path):
                fits.append((len(rule), len(rule_host), rule))
        best = max(fits)[2] if fits else None
        assert (found[i].host, found[i].path, found[i].rule) == (host, path, best), address
        assert found[i].verdict == (usable[best] if best else "allow")
    nothing = urls.judge(pages, urls.build(spark.createDataFrame([], "rule string, verdict string")))
    assert {r.verdict for r in nothing.collect()} == {"allow"}


def test_equal_digests_are_told_apart(tmp_path):
    import xxhash

    digest = np.array([xxhash.xxh64_intdigest(b"a/", seed=42)] * 2, np.uint64)
    parts = (np.array([2, 1], np.uint64), np.array([1], np.uint64), digest, np.array([2, 4], np.uint64), np.array([0, 1], np.uint8))
    (tmp_path / "rules").write_bytes(b"".join(p.tobytes() for p in parts) + b"b/a/")
    assert urls.Rules([str(tmp_path / "rules")]).find([b"a/", b"z/"]) == [1, None]


@pytest.mark.parametrize(("factor", "shard_rows", "recall"), [(1.0, 8192, 1.0), (1.0, 150, 1.0), (1.3, 8192, 0.9)])
def test_neighbours(spark, factor, shard_rows, recall):
    draw = np.random.default_rng(3)
    points = draw.normal(size=(600, 8)).astype(np.float32)
    points[100:400] = points[100]  # half of all are one vector
    rows = [(i, p.tolist(), 1) for i, p in enumerate(points)]
    rows += [(1000, None, 1), (1001, [0.0] * 8, 1), (1002, [float("nan")] * 8, 1), (1003, [None] * 8, 1), (None, points[0].tolist(), 1), rows[7]]
    rows += [(1020 + i, [1.0, 2.0 * i], 1) for i in range(3)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, score int")
    found = vptree.nearest(table, F.col("vec_id") % 20 == 0, 20, factor=factor, shard_rows=shard_rows).collect()
    by_query = {}
    for r in found:
        by_query.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert set(by_query) == {*range(0, 600, 20), 1020}
    assert sorted(v[0] for v in by_query[1020].values()) == [1021, 1022]
    wide, hits = points.astype(float), 0
    for q in range(0, 600, 20):
        scores = np.cumsum(wide * wide[q], axis=1)[:, -1]  # added in order
        want = [int(i) for i in np.lexsort((np.arange(600), -scores)) if i != q][:20]
        mine = [by_query[q][rank][0] for rank in range(1, 21)]
        assert all(by_query[q][rank][1] == scores[by_query[q][rank][0]] for rank in range(1, 21))
        hits += len({*want} & {*mine})
        assert factor > 1 or mine == want
    assert hits / 600 >= recall
    assert vptree.nearest(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0
