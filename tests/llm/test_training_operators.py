"""Phrase collocations, importance resampling and lattice scores against brute force."""

import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluiceway.llm import lattice, phrases, queries, resample

ODD = [None, "", " \n\t", "word", "é", "A B", "a b", "x" * 3000, "#%& " * 60, ".;.", "½ Ⅷ"]


def docs_of(spark, texts, langs=("en",)):
    rows = [(i, t, langs[i % len(langs)], 9, 1, 2, b"") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, n bigint, a int, score int, word binary")


def prose(seed, n, kinds=40):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(kinds)]
    return " ".join(draw.choices(words, [1 / (i + 1) for i in range(kinds)], k=n)[i] + draw.choice(["", "", "", ",", "."]) for i in range(n))


# Phrases


def phrases_by_brute_force(rows, least, longest, top):
    counts, sizes = {}, Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + m])] += 1
    out = []
    for lang, f in counts.items():
        n, found = sizes[lang], []
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = set()
        for p, a in often.items():
            for m in range(2, len(p)):
                inside |= {p[i : i + m] for i in range(len(p) - m + 1) if often[p[i : i + m]] == a}
        for p, a in often.items():
            if p not in inside:
                score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -score))
    return sorted(out)


@pytest.mark.parametrize("top, share, block", [(10, 0.125, 4_000), (10_000, 0.125, 1 << 20), (60, 0.6, 900)])
def test_phrases(spark, top, share, block):
    shared = "rare words stand here together once"
    texts = [*ODD, *(prose(i, 300) for i in range(30)), *[f"{shared} {prose(99, 3)} Above All" for _ in range(12)]]
    texts += [texts[20], "above all. " * 40, "a" * 10 + " b" * 300]
    langs = ["en", "de", None]
    docs = docs_of(spark, texts, langs)
    found = phrases.collocations(docs, least=6, top=top, first_share=share, block_bytes=block).collect()
    want = phrases_by_brute_force([(r.text, r.lang) for r in docs.collect()], 6, 5, top)
    assert sorted(map(tuple, found)) == want
    assert len(want) > 20


def test_phrases_leave_a_task_in_small_batches(monkeypatch):
    monkeypatch.setattr(phrases, "BATCH_ROWS", 3)
    texts = phrases._Texts()
    texts.add(b"a b c d e f. a b c g h")
    row = texts.row(7, "en")
    none = pa.nulls(1)
    row = pa.RecordBatch.from_arrays([*row.columns, pa.array([9]), none, none], names=[*row.schema.names, "reach", "classes", "kept"])
    *found, places = phrases._grow(2, iter([row]))
    assert [len(b) for b in found] == [3, 3, 1]
    said = {r["phrase"]: (r["place"], r["n"]) for b in found for r in b.to_pylist()}
    assert {p: n for p, (_, n) in said.items()} == {b"a b": 2, b"b c": 2, b"c d": 1, b"d e": 1, b"e f": 1, b"c g": 1, b"g h": 1}
    assert sorted(place for place, _ in said.values()) == list(range(1, 8))
    placed = phrases.unpacked(places.column("classes")[0].as_py())
    ids = phrases.unpacked(row.column("ids")[0].as_py())
    words = row.column("words")[0].as_py()
    assert {(words[ids[i]] + b" " + words[ids[i + 1]], p) for i, p in enumerate(placed.tolist()) if p} == {(w, p) for w, (p, _) in said.items()}


def test_no_phrases(spark):
    docs = docs_of(spark, ODD)
    assert phrases.collocations(docs).collect() == []
    assert phrases.collocations(docs.where("doc_id < 0")).collect() == []
    assert phrases.collocations(docs.where("text is null")).collect() == []


def test_phrases_beyond_64_bits(spark):
    score = spark.range(1).select(
        F.expr("cast(1000 as decimal(4,0)) * cast(90000000000 as decimal(19,0)) * cast(9000000000000 as decimal(19,0)) div (cast(90000000001 as decimal(19,0)) * cast(90000000000 as decimal(19,0)))")
    )
    assert score.first()[0] == 1000 * 90000000000 * 9000000000000 // (90000000001 * 90000000000)


# Resampling


def test_features_are_checksums_of_word_runs():
    text = "Héllo, WORLD_x 12 — the end"
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    runs = [" ".join(words[i : i + m]) for m in (1, 2, 3) for i in range(len(words) - m + 1)]
    n, found = resample.features(text.encode())
    assert n == len(words) and found.tolist() == [zlib.crc32(r.encode()) % 10_000 for r in runs]
    assert [len(resample.features(t)[1]) for t in (b"", b" ", b"a", b"a b", b"a b c")] == [0, 0, 1, 3, 6]


def resampled_by_brute_force(rows, target, percent, least):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    runs = lambda w: [zlib.crc32(" ".join(w[i : i + m]).encode()) % 10_000 for m in (1, 2, 3) for i in range(len(w) - m + 1)]
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(runs(cut(text)))
    for text in target:
        t.update(runs(cut(text)))
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000)))) for b in range(10_000)]
    out = []
    for key, text in rows:
        words = cut(text)
        found = runs(words)
        weight = sum(gain[b] for b in found)
        h = int(sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[5] = rank
    return sorted(map(tuple, out), key=str)


def test_resampling(spark):
    texts = [*ODD, *(prose(i, 30 + i) for i in range(60)), prose(7, 5000)]
    docs = docs_of(spark, texts).unionAll(docs_of(spark, ["lost " * 25]).withColumn("doc_id", F.lit(None).cast("bigint")))
    target = spark.createDataFrame([(1, prose(3, 200)), (2, None), (3, "w1 w2 w3")], "item_id int, text string")
    found = resample.resample(docs, target, percent=25).collect()
    want = resampled_by_brute_force([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()], 25, 20)
    assert sorted(map(tuple, found), key=str) == want
    ids = {r.doc_id for r in found if r["rank"]}
    rows = resample.drawn(docs, target, percent=25)
    assert rows.columns == docs.columns and {r.doc_id for r in rows.collect()} == ids
    again = resample.resample(docs.repartition(5), target, percent=25).collect()
    assert sorted(map(tuple, again), key=str) == want


def test_resampling_of_repeated_rows_and_nothing(spark):
    docs = docs_of(spark, [prose(1, 40)] * 3).withColumn("doc_id", F.lit(5).cast("bigint"))
    target = docs.select("text").limit(0)
    found = resample.resample(docs, target, percent=67).collect()
    assert sorted((r["rank"] for r in found), key=str) == [1, 2, None]
    assert len({(r.doc_id, r.weight, r.score) for r in found}) == 1
    assert resample.resample(docs.limit(0), target).collect() == []
    assert resample.resample(docs, docs.select("text"), percent=0).where("rank is not null").collect() == []


# Lattice scores

PIECES = [b" ", b" a", b"a", b"b", b"ab", b"ba", b" ab", b"c", b"abc"]


def all_ways(word, scores):
    """Log of the summed probability of all segmentations, and the expected uses of each piece."""
    total, used = 0.0, np.zeros(len(scores))

    def go(at, chance, pieces):
        nonlocal total
        if at == len(word):
            total += chance
            for p in pieces:
                used[p] += chance
        for number, piece in enumerate(PIECES):
            if word.startswith(piece, at):
                go(at + len(piece), chance * math.exp(scores[number]), [*pieces, number])

    go(0, 1.0, [])
    return math.log(total), used / total


@pytest.mark.parametrize("window", [4, 10, 1 << 16])
def test_lattice_sums_all_segmentations(window):
    scores = np.log(np.random.default_rng(0).dirichlet(np.ones(len(PIECES))))
    trie, words = lattice.Trie(PIECES), [b"abcab", b"a", b"ba", b"cababcabab", b"abab", b"c"]
    used = np.zeros(len(PIECES))
    for places, made in lattice._lattices(trie, words, window):
        for place, found in zip(places, made.forward(scores)[made.ends]):
            assert found == pytest.approx(all_ways(b" " + words[place], scores)[0])
        used += made.expected(scores) / lattice.UNIT
    assert used == pytest.approx(sum(all_ways(b" " + w, scores)[1] for w in words), abs=1e-4)


def test_scores(spark):
    texts = [*ODD, *(prose(i, 200) for i in range(40)), "unseenword w1", "qz" * 50_000]
    docs = docs_of(spark, texts)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    model = lattice.learn(docs.where(~held), queries.vocabulary_file(queries.PIECES))
    found = {r.doc_id: r for r in lattice.score(docs, model, held).collect()}
    cut = {i: re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) for i, t in enumerate(texts)}
    out = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in cut}
    counts = Counter(w for i, words in cut.items() if not out[i] for w in words)
    ends = sum(not o for o in out.values())
    n, kinds = sum(counts.values()) + ends, len(counts) + 1
    base = lambda c: math.log10((c + 0.5) / (n + 0.5 * (kinds + 1)))
    words = sorted({w for c in cut.values() for w in c})
    spelled = {}
    for places, made in lattice._lattices(model.trie, words, 1 << 16):
        spelled |= {words[p]: s for p, s in zip(places, made.forward(model.scores)[made.ends])}
    once, twice = sum(c == 1 for c in counts.values()), sum(c == 2 for c in counts.values())
    d = (once + 1) / (once + 2 * twice + 2)
    rest = d * kinds + 1

    def token(word):
        log = math.log(rest * (1 - lattice.UNSEEN_END)) + spelled[word] + model.stop
        whole = np.logaddexp(math.log(counts[word] - d) if counts[word] else -np.inf, log)
        return float(whole - math.log(n + 1)) / math.log(10)

    assert set(found) == set(cut)
    for i, tokens in cut.items():
        row = found[i]
        assert (row.held_out, row.n_tokens, row.train_tokens) == (out[i], len(tokens) + 1, n)
        assert row.n_known == sum(counts[w] > 0 for w in tokens) + 1
        assert row.base_score == pytest.approx(math.fsum(base(counts[w]) for w in tokens) + base(ends))
        end = math.log10((ends - d + rest * lattice.UNSEEN_END) / (n + 1))
        assert row.score == pytest.approx(math.fsum(map(token, tokens)) + end)
        assert math.isfinite(row.score)
    again = {r.doc_id: r.score for r in lattice.score(docs.repartition(3), model, held, window=1 << 12).collect()}
    assert again == pytest.approx({i: r.score for i, r in found.items()})


def test_a_text_is_likelier_than_its_letters_turned_around(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    model = lattice.learn(docs.where(~held), queries.vocabulary_file(queries.PIECES))
    both = [lattice.score(d, model, held).where("held_out").agg(F.sum("score")).first()[0] for d in (docs, docs.withColumn("text", F.reverse("text")))]
    assert both[1] < 1.5 * both[0] < 0
    # The probabilities of all words of one letter, and of an end, stay below one.
    letters = spark.createDataFrame([(i, chr(97 + i)) for i in range(26)] + [(26, "")], "doc_id int, text string")
    total = lattice.score(letters, model, F.lit(False)).select(F.sum(F.pow(F.lit(10.0), "score")), F.max("score")).first()
    assert total[0] < 1 and total[1] < 0


def test_scores_of_nothing(spark):
    docs = docs_of(spark, ODD)
    none = lattice.learn(docs.where("false"), queries.vocabulary_file(queries.PIECES))
    rows = lattice.score(docs, none, F.lit(None).cast("boolean")).collect()
    assert all(r.base_score == 0 and r.n_known == 0 and r.score < 0 and r.held_out is False for r in rows)
    assert lattice.score(docs.where("false"), none, F.lit(True)).collect() == []
