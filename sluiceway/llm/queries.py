"""One query per operator, over its whole table; the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm import bpe, language, lattice, mixing, phrases, quality, repair, resample, simhash, suffixes, urls, vptree, warc
from sluiceway.llm.common import table

BYTE_BPE = "byte_bpe_multi_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"
#: Every fifth document (by checksum of its id) is held out of what the language model learns from.
FOLDS = 5
URL_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def vocabulary_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pre_token_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))
    docs = table(spark, sf_dir, "documents")
    model = language.learn(docs.where(~held))
    found = language.predict(docs, model)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = urls.build(spark.createDataFrame(list(URL_RULES), "rule string, verdict string"))
    return urls.judge(table(spark, sf_dir, "pages"), rules)


def op6_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.col("kept_text").alias("text"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary_file(BYTE_BPE), pre_token_pattern())


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_warc(warc.write_warc(table(spark, sf_dir, "pages")))


def op9_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op10_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.read_ids(repair.write_ids(table(spark, sf_dir, "documents"), vocabulary_file(WORD_BPE)))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 1, F.lit(False))
    docs = table(spark, sf_dir, "documents")
    model = lattice.learn(docs.where(~held), vocabulary_file(PIECES))
    return lattice.score(docs, model, held)


_OP5 = """
WITH parts AS (
  SELECT page_id,
    CASE WHEN strpos(coalesce(url, ''), '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages
), split AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw_host, rest FROM parts
), named AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path
  FROM split
), fits AS (
  SELECT *,
    (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' AS a,
    (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' AS b,
    (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' AS c,
    (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' AS d
  FROM named
)
SELECT page_id, host, path,
  CASE WHEN a THEN 'example.net/en/' WHEN b THEN 'example.com/de/' WHEN c THEN 'org/fr/' WHEN d THEN 'net/' END AS rule,
  CASE WHEN a THEN 'allow' WHEN b THEN 'block' WHEN c THEN 'allow' WHEN d THEN 'block' ELSE 'allow' END AS verdict
FROM fits
"""

_OP9 = """
WITH v AS (
  SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL
), near AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM near
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

_OP11 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), cut AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), runs AS (
  SELECT lang, m, unnest(list_transform(range(greatest(len(w) - m + 1, 0)), lambda i: array_to_string(w[i + 1 : i + m], ' '))) AS phrase
  FROM cut, (SELECT unnest(range(1, 6)) AS m)
), f AS (
  SELECT lang, m, phrase, count(*) AS a FROM runs GROUP BY ALL
), sizes AS (
  SELECT lang, sum(a)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang
), often AS (
  SELECT * FROM f WHERE m >= 2 AND a >= 100
), cuts AS (
  SELECT lang, phrase, a, k, string_split(phrase, ' ') AS w, m FROM (SELECT *, unnest(range(1, m)) AS k FROM often)
), scored AS (
  SELECT c.lang, c.phrase, c.a, l.a AS l, r.a AS r, n,
    row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY (1000::HUGEINT * c.a * n) // (l.a::HUGEINT * r.a), k) AS place,
    ((1000::HUGEINT * c.a * n) // (l.a::HUGEINT * r.a))::BIGINT AS score
  FROM cuts c JOIN sizes USING (lang)
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:c.m], ' ')
), kept AS (
  SELECT * FROM scored s WHERE place = 1 AND NOT EXISTS (
    SELECT 1 FROM often x WHERE x.lang = s.lang AND x.a = s.a AND x.phrase <> s.phrase AND contains(' ' || x.phrase || ' ', ' ' || s.phrase || ' '))
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
"""

_OP12 = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i::UBIGINT, range(8)::UBIGINT[]),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)) AS t
), texts AS (
  SELECT 'd' AS kind, row_number() OVER () AS row, doc_id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), NULL, text FROM benchmark
), cut AS (
  SELECT kind, row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts
), runs AS (
  SELECT kind, row, unnest(list_concat(w,
    list_transform(range(greatest(len(w) - 1, 0)), lambda i: w[i + 1] || ' ' || w[i + 2]),
    list_transform(range(greatest(len(w) - 2, 0)), lambda i: w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]))) AS feature
  FROM cut
), counted AS (
  SELECT kind, row, feature, count(*) AS n FROM runs GROUP BY ALL
), hexed AS (
  SELECT feature, hex(encode(feature)) AS h FROM (SELECT DISTINCT feature FROM counted)
), hashed AS (
  SELECT feature, xor(list_reduce(list_prepend(4294967295::UBIGINT,
      list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::UBIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT) % 10000 AS bucket
  FROM hexed, crc
), buckets AS (
  SELECT bucket, coalesce(sum(n) FILTER (kind = 'd'), 0) AS s, coalesce(sum(n) FILTER (kind = 'b'), 0) AS t
  FROM counted JOIN hashed USING (feature) GROUP BY bucket
), totals AS (
  SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM buckets
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000)::DOUBLE / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS gain
  FROM buckets, totals
), weighed AS (
  SELECT row, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
  FROM counted JOIN hashed USING (feature) JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY row
), scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM cut LEFT JOIN weighed USING (row) WHERE kind = 'd'
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
    5 * count(*) OVER (PARTITION BY n_words >= 20) // 100 AS draws
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= draws THEN place END AS rank FROM ranked
"""

_ALL = (op1_simhash, op2_language, op3_mixing, op4_quality, op5_urls, op6_suffixes, op7_bpe, op8_warc, op9_vptree, op10_repair, op11_phrases, op12_resample, op13_lattice)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in _ALL}


def oracles() -> dict[str, str]:
    return {"op5_urls": _OP5.strip(), "op9_vptree": _OP9.strip(), "op11_phrases": _OP11.strip(), "op12_resample": _OP12.strip()}
