"""Near-duplicates, language, mixing, quality, repeats and the pipeline against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluiceway.llm import bpe, common, language, mixing, quality, queries, simhash, suffixes

ODD = [None, "", " \n\t", "word", "é", "A B", "a b", "x" * 3000, "#%& " * 60]


def docs_of(spark, texts, **more):
    rows = [(i, t, more.get("lang", "en"), f"s{i % 3}" if i % 7 else None, len(t or ""), "kept", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, kept int")


def prose(seed, n, words="the of and red blue green stone river cloud light house".split()):
    draw = random.Random(seed)
    return " ".join(draw.choice(words) + draw.choice("abcdefgh") for _ in range(n))


def groups_by_brute_force(found):
    ids = [r.doc_id for r in found]
    prints = np.array([int(r.fingerprint, 16) for r in found], np.uint64)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= 3):
            a, b = find(ids[i]), find(ids[int(j)])
            root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("bucket_rows", [4096, 2])
def test_near_duplicates(spark, bucket_rows):
    base = prose(1, 900).split()
    texts = list(ODD)
    for k in range(40):
        words = list(base)
        words[k * 20] = "changed"
        texts.append(" ".join(words))
    texts += [prose(s, 120) for s in range(2, 12)] + texts[-3:]
    found = simhash.near_duplicates(docs_of(spark, texts), bucket_rows=bucket_rows).collect()
    assert len(found) == len(texts)
    assert {r.doc_id: r.component_id for r in found} == groups_by_brute_force(found)
    by_id = {r.doc_id: r for r in found}
    assert by_id[0].fingerprint == by_id[1].fingerprint == "0" * 16
    assert len({r.component_id for r in found}) < len({r.fingerprint for r in found})


def test_fingerprint_is_the_majority_of_shingle_hashes():
    import xxhash

    text = "One two  three\nfour ÄÖ five"
    words = [w.lower() if w.isascii() else w for w in text.split()]
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), seed=42) for i in range(len(words) - 2)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text.encode()) == want
    assert simhash.fingerprint(b"A b") == xxhash.xxh64_intdigest(b"a b", seed=42)


def test_masks_cover_every_pair_within_the_radius():
    covering, draw = [m % (1 << 64) for m in simhash.masks()], random.Random(2)
    for _ in range(3000):
        flipped = sum(1 << b for b in draw.sample(range(64), 3))
        assert any(not m & flipped for m in covering)


def test_one_row_of_each_group_stays(spark):
    docs = docs_of(spark, [*ODD, prose(1, 300), prose(1, 300), prose(2, 300)])
    docs = docs.unionAll(docs.where("doc_id in (3, 9)")).unionAll(docs.where("doc_id = 11").withColumn("doc_id", F.lit(None).cast("bigint")))
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    groups = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(groups)
    assert simhash.keep_first(docs.limit(0)).count() == 0


def test_the_pipeline_cuts_passages_of_51_words(spark):
    import corpus_pipeline

    own = [prose(20 + i, 60) for i in range(4)]
    passage = prose(7, 51, "the river runs below a green hill where light falls on old stone".split())
    assert 200 < len(passage) < 400
    docs = docs_of(spark, [f"{t[:150]} {passage} {t[150:]}" for t in own] + [prose(30, 80)])
    for r in corpus_pipeline.cut_repeats(spark, docs, "").collect():
        assert passage[4:-4] not in r.text
        assert r.doc_id == 4 or own[r.doc_id][:140] in r.text and own[r.doc_id][-100:] in r.text


def covered(texts, length):
    seen = {}
    for i, t in enumerate(texts):
        for p in range(len(t) - length + 1):
            seen.setdefault(t[p : p + length], []).append((i, p))
    marks = [np.zeros(len(t), bool) for t in texts]
    for places in seen.values():
        for i, p in places if len(places) > 1 else ():
            marks[i][p : p + length] = True
    return marks


@pytest.mark.parametrize(("length", "gram", "group_rows"), [(40, 16, 20_000), (40, 16, 3), (40, 10, 5), (30, 25, 20_000)])
def test_repeats(spark, length, gram, group_rows):
    draw = random.Random(4)
    letters = lambda n: "".join(draw.choices("abcdé \n", k=n))
    passages, texts = [letters(draw.randint(30, 90)) for _ in range(6)], []
    for _ in range(50):
        text = letters(draw.randint(0, 30))
        for _ in range(draw.randint(0, 3)):
            passage, at = draw.choice(passages), draw.randint(0, 20)
            text += passage[at : at + draw.randint(20, 70)] + letters(draw.randint(0, 10))
        texts.append(text)
    texts += [*ODD, "a" * 200, "ab" * 100, texts[3], texts[3], passages[0], "é" * 90, "\x00" * 100 + "a"]
    raw = [(t or "").encode() for t in texts]
    docs = docs_of(spark, texts)
    found = {r.doc_id: r for r in suffixes.remove_repeats(docs, length=length, gram=gram, group_rows=group_rows).collect()}
    for i, (text, marks) in enumerate(zip(raw, covered(raw, length))):
        kept = bytes(np.frombuffer(text, np.uint8)[~marks])
        starts = int(np.count_nonzero(np.diff(np.concatenate([[0], marks.astype(int)])) == 1))
        assert (found[i].n_bytes, found[i].n_removed, found[i].n_spans) == (len(text), int(marks.sum()), starts)
        assert found[i].kept_sha256 == hashlib.sha256(kept).hexdigest()
    cut = suffixes.repeats_removed(docs, length=length, gram=gram)
    assert cut.columns == docs.columns and cut.count() == len(texts)
    assert cut.where("text is null").count() == 1
    assert suffixes.remove_repeats(docs.limit(0), length=length, gram=gram).count() == 0


def test_anchors_do_not_depend_on_parts():
    text = "".join(random.Random(1).choices("abc ", k=5000)).encode()
    whole = suffixes.anchors([text], 60, 20)
    parts = suffixes.anchors([text], 60, 20, part=128)
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts))


def test_anchors_do_not_depend_on_where_a_long_text_holds_them():
    text = random.Random(5).randbytes((17 << 20) + 12_345)
    tail = text[(16 << 20) - 5_000 :]
    which, place, found = suffixes.anchors([text, tail], 400, 64)
    inside = (which == 0) & (place >= len(text) - len(tail) + 400)
    again = (which == 1) & (place >= 400)
    assert np.count_nonzero(again) > 2_000
    assert np.array_equal(place[inside] - (len(text) - len(tail)), place[again])
    assert np.array_equal(found[inside], found[again])


def test_targets_share_again_what_exceeds_a_limit():
    due = mixing.targets({"a": 100, "b": 1000, None: 1000, "c": 0})
    assert due["a"] == 300 and due["c"] == 0
    assert sum(due.values()) == pytest.approx(2100)
    assert due["b"] / due[None] == pytest.approx(2 / 5)  # fourth in order: 5, 2, 1, 5


def test_flow_prefers_documents_of_both_sources_before_repeats():
    given = mixing.plan({("a",): 10, ("b",): 10, ("a", "b"): 10}, {"a": 15.0, "b": 15.0})
    assert given == {("a",): 10, ("b",): 10, ("a", "b"): 10}
    given = mixing.plan({("a",): 10, ("a", "b"): 10}, {"a": 30.0, "b": 10.0})
    assert sum(given.values()) == 40 and max(given.values()) <= 30


@pytest.mark.parametrize("bucket_docs", [1000, 1])
def test_mix_comes_near_its_targets(spark, bucket_docs):
    texts = [prose(i, 5 + i % 40) for i in range(400)] + ODD
    docs = docs_of(spark, texts).withColumn("source", F.expr("case when doc_id % 8 = 7 then null when doc_id < 300 then 'big' else concat('s', doc_id % 3) end"))
    found = mixing.mix_sources(docs, bucket_docs=bucket_docs).collect()
    assert len(found) == len(texts)
    assert sorted(found) == sorted(mixing.mix_sources(docs, bucket_docs=bucket_docs).collect())
    source = {r.doc_id: r.source for r in docs.collect()}
    for s in set(source.values()):
        mine = [r for r in found if source[r.doc_id] == s]
        assert {r.source_size for r in mine} == {sum(r.size for r in mine)}
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 45
    assert all(r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0) for r in found)
    repeated = mixing.mixed_documents(docs, bucket_docs=bucket_docs)
    assert repeated.columns == docs.columns
    assert repeated.select(F.sum(mixing.word_count(F.col("text")))).first()[0] == sum(r.taken for r in found)
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def test_mix_keeps_sources_without_words_beside_a_large_one(spark):
    texts = [prose(i, 1 + i % 9) for i in range(600)] + [None, "", " \n"] * 3
    docs = docs_of(spark, texts).withColumn("source", F.expr("case when doc_id < 600 then 'big' when doc_id % 2 = 0 then 'blank' end"))
    found = {r.doc_id: r for r in mixing.mix_sources(docs, bucket_docs=1).collect()}
    assert sorted(found) == list(range(len(texts)))
    assert all((found[i].size, found[i].source_size, found[i].taken) == (0, 0, 0) for i in range(600, len(texts)))
    assert sum(r.taken for r in found.values()) > 0


def brute_signals(text):
    words, lines = (text or "").split(), (text or "").split("\n")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in lines:
        if line.split():
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(hit)


def test_quality_signals_and_cutoffs(spark):
    good = [prose(i, 80) for i in range(600)]
    bad = [" ".join(w + "###" for w in prose(i, 80).split()) for i in range(200)]
    texts = [*ODD, "a b c a b c\na b c\na b c\n\n x", "one\none\n one\none", *good, *bad]
    docs, first = docs_of(spark, texts), len(texts) - 800
    labels = [(first + i, int(i < 600), 0) for i in range(800)] + [(None, 0, 0), (first, None, 1)]
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    found = {r.doc_id: r for r in quality.quality_rules(docs, labels, risk=0.1).collect()}
    for i, text in enumerate(texts):
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_signals(text)
        assert r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words)
    assert all(found[first + i].kept for i in range(600))
    assert not any(found[first + i].kept for i in range(600, 800))
    kept = quality.keep_good(docs, labels, risk=0.1)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, r in found.items() if r.kept)
    assert all(r.kept != r.base_failed for r in quality.quality_rules(docs, labels.limit(0)).collect())


def test_binomial_bound():
    from math import comb

    for n, k, p in ((50, 1, 0.1), (300, 0, 0.01), (300, 2, 0.03)):
        assert quality.at_most(k, n, p) == pytest.approx(sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)))
    assert quality.choose(np.array([1000, 50, 0, 0]), np.array([0, 10, 10, 10]), 0.01, 0.05) == 1


def test_language(spark):
    french = "le la les un une des maison rivière été où forêt être avec pour dans".split()
    texts = [prose(i, 60) for i in range(60)] + [prose(100 + i, 60, french) for i in range(40)]
    docs = docs_of(spark, texts).withColumn("lang", F.when(F.col("doc_id") < 60, "en").otherwise("fr"))
    held = F.col("doc_id") % 5 == 0
    model = language.learn(docs.where(~held).unionAll(docs.withColumn("lang", F.lit(None).cast("string"))))
    assert list(model) == ["en", "fr"]
    found = language.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.lang_pred == r.lang and 0 < r.score <= 1 for r in found)
    odd = {r.doc_id: r for r in language.predict(docs_of(spark, [*ODD, "12 %%"]), model).collect()}
    assert [odd[i].lang_pred for i in (0, 1, 2, len(ODD))] == ["und"] * 4
    assert odd[3].lang_pred in model
    assert {r.lang_pred for r in language.predict(docs, {}).collect()} == {"und"}


def test_languages_against_a_plain_loop(spark):
    import zstandard

    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = language.learn(docs.where(~held))
    truth, right, total = {r.doc_id: r for r in docs.collect()}, 0, 0
    for r in queries.op2_language(spark, path).collect():
        text = re.sub(r"[^a-zäöüßàâæçéèêëîïôœùûÿñáíóúì]+", " ", truth[r.doc_id].text.lower()).strip().encode()
        if text != language.letters(truth[r.doc_id].text):
            continue  # other letters
        sizes = []
        for content in model.values():
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            made = zstandard.ZstdCompressor(level=9, dict_data=dictionary, write_content_size=False, write_dict_id=False)
            sizes.append(sum(len(made.compress(text[i : i + 4096])) for i in range(0, len(text), 4096)))
        if text:
            assert r.lang_pred == list(model)[int(np.argmin(sizes))]
            rest = sorted(sizes)
            assert r.score == pytest.approx(1 - rest[0] / rest[1])
        right, total = right + (r.held_out and r.lang_pred == truth[r.doc_id].lang), total + r.held_out
    assert total > 20 and right > 0.95 * total


def test_texts_of_numbers_have_no_language(spark):
    model = {"en": b"the of and to in that is was" * 20, "fr": b"le la les des une que dans" * 20}
    texts = ["½", "Ⅷ", "②①", "²", "12 ٣", "_", "½ a"]
    found = {r.doc_id: r.lang_pred for r in language.predict(docs_of(spark, texts), model).collect()}
    assert [found[i] for i in range(6)] == ["und"] * 6 and found[6] in model


def test_copies_of_labelled_texts_are_one_holdout(spark):
    good = [prose(i, 80) for i in range(50)]
    bad = [" ".join(w + "###" for w in prose(i, 80).split()) for i in range(20)]
    docs = docs_of(spark, [*good, *bad])
    labels = spark.createDataFrame([(i, int(i < 50)) for i in range(70)], "doc_id bigint, quality int")
    many = docs.withColumn("doc_id", F.explode(F.transform(F.sequence(F.lit(0), F.lit(99)), lambda i: F.col("doc_id") + 70 * i)))
    for rows in (docs, many, docs.crossJoin(spark.range(100).select())):
        named = labels.crossJoin(spark.range(100)).select((F.col("doc_id") + 70 * F.col("id")).alias("doc_id"), "quality")
        assert rows.count() == quality.quality_rules(rows, named, risk=0.1).where("kept").count()
        assert rows.count() == quality.keep_good(rows, named, risk=0.1).count()


CLASHES = "k1 k2 _k _s _n _z _s_ row_hash first_hash key spans hash stratum h1 h2 fp component bucket uses_of_mix source_ text_ words size"


def test_names_of_columns_never_clash(spark):
    import corpus_pipeline

    path, plain = "/root/testdata/sf0.001", spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(80)
    docs = plain.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES.split())])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found, want = stage(spark, docs, path), stage(spark, plain, path)
        assert found.columns == docs.columns, name
        assert sorted(map(tuple, found.select(plain.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str), name
        assert found.select(*CLASHES.split()).distinct().collect() == [tuple(range(len(CLASHES.split())))], name
    assert corpus_pipeline.encode(spark, docs, path).count() == 80


def test_stages_on_nothing_nulls_and_repeated_rows(spark):
    import corpus_pipeline

    path = "/root/testdata/sf0.001"
    docs = spark.createDataFrame(
        [(1, None, None, None, None), (None, "", "en", "a", 0), (2, "word", None, "a", 4), (2, "word", None, "a", 4), (3, prose(1, 90), "en", None, 1), (4, prose(1, 90) + " x", "en", "b", 1)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    ids = {}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), path).count() == 0, name
        ids[name] = sorted((r.doc_id for r in stage(spark, docs, path).collect()), key=str)
    assert list(ids.values())[0] == [3, 4]
    assert list(ids.values())[1] in ([1, 2, 3], [1, 2, 3, 4])
    assert list(ids.values())[2] == list(ids.values())[4] == [1, 2, 2, 3, 4, None]


def test_pipeline_against_brute_force(spark):
    import corpus_pipeline

    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet")
    labels = spark.read.parquet(f"{path}/labels.parquet")
    good = {r.doc_id for r in quality.quality_rules(docs, labels).where("kept").collect()}
    near = simhash.near_duplicates(docs.where(F.col("doc_id").isin(*good))).collect()
    firsts = set(groups_by_brute_force(near).values())
    rows = sorted((r for r in docs.collect() if r.doc_id in firsts), key=lambda r: r.doc_id)
    raw = [r.text.encode() for r in rows]
    cut = []
    for row, text, marks in zip(rows, raw, covered(raw, corpus_pipeline.PASSAGE_BYTES)):
        spans = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(int), [0]]))).reshape(-1, 2).tolist()
        cut.append((row.doc_id, suffixes.without(text, spans).decode(), row.lang, row.source, None))
    frame = spark.createDataFrame(cut, docs.schema)
    want = bpe.digests(mixing.mixed_documents(frame), queries.vocabulary_file(queries.BYTE_BPE), queries.pre_token_pattern())
    start = common.stored_so_far()
    assert sorted(map(tuple, corpus_pipeline.run(spark, path).collect())) == sorted(map(tuple, want.collect()))
    assert common.stored_so_far() == start + 1  # the input of the last stage, which is read lazily
    common.forget(spark, start)
    assert common.stored_so_far() == start


def test_flow_against_a_search(spark):
    """Of all ways to use small patterns up to three times, none comes nearer to what is due at a lower cost."""
    draw = random.Random(3)
    for _ in range(30):
        kinds = draw.sample([("a",), ("b",), ("a", "b"), ("b", "c"), ("c",)], 3)
        weight = {k: draw.randint(1, 3) for k in kinds}
        names = sorted({s for k in kinds for s in k})
        due = {s: float(draw.randint(0, 6)) for s in names}
        given = mixing.plan(weight, due)

        def flows(left, drained):
            """(words taken in all, cost) of every way to send whole words of patterns to sources."""
            if not left:
                yield sum(sum(d.values()) for d in drained), 0
                return
            k, *more = left
            for used in range(3 * weight[k] + 1):
                cost = sum((0, 1, 4)[u // weight[k]] for u in range(used))
                for first in range(used + 1) if len(k) > 1 else [used]:
                    parts = {k[0]: first} | ({k[1]: used - first} if len(k) > 1 else {})
                    so_far = {s: sum(d.get(s, 0) for d in [*drained, parts]) for s in names}
                    if all(so_far[s] <= due[s] for s in names):
                        for total, rest in flows(more, [*drained, parts]):
                            yield total, cost + rest

        best = min((-total, cost) for total, cost in flows(kinds, []))
        mine = sum((0, 1, 4)[u // weight[k]] for k in kinds for u in range(given[k]))
        assert (-sum(given.values()), mine) == best


def test_a_passage_in_many_texts_and_long_periodic_texts(spark):
    """Time follows the texts: a passage twice as frequent costs about twice as much, ten megabytes of one period seconds."""
    import time

    passage = prose(5, 120)[:700]
    took = []
    for n in (4_000, 8_000):
        docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.sha2(F.col("id").cast("string"), 512), F.lit(passage), F.sha2(F.concat(F.lit("x"), "id"), 512)).alias("text"))
        began = time.time()
        found = suffixes.remove_repeats(docs, group_rows=1_000).agg(F.min("n_removed"), F.max("n_removed"), F.count("*")).first()
        took.append(time.time() - began)
        # The passage, and what neighbours happen to share beyond it.
        assert len(passage) <= found[0] <= found[1] < len(passage) + 12 and found[2] == n
    assert took[1] < 4 * took[0] + 10
    periodic = spark.createDataFrame([(1, "x " * (5 << 20)), (2, "x " * 300 + "y"), (3, "z")], "doc_id bigint, text string")
    began = time.time()
    found = {r.doc_id: (r.n_removed, r.n_spans) for r in suffixes.remove_repeats(periodic).select("doc_id", "n_removed", "n_spans").collect()}
    assert found == {1: (10 << 20, 1), 2: (600, 1), 3: (0, 0)}
    assert time.time() - began < 120
