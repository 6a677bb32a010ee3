"""Language by compression: the dictionary of one's own language makes a text smallest."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import Batches, picked, raw_bytes, stored

#: What is learned from a language: so many documents, so many characters of each, so many bytes in all.
SAMPLE_DOCS = 400
SAMPLE_CHARS = 1_000
DICTIONARY_BYTES = 64 << 10
#: Dictionaries of all languages together; more is an error, never a silent cut.
MODEL_LIMIT = 64 << 20
BLOCK_BYTES = 4 << 10
LEVEL = 9
#: A prediction is marked as rejected if the second-best language is closer than this share.
LEAST_MARGIN = 0.01
UNKNOWN = "und"
_NO_LETTERS = regex.compile(r"\P{L}+")


def letters(text: str) -> bytes:
    """The letters alone, in lower case: marks, numbers of any kind and capitals say little about a language."""
    return _NO_LETTERS.sub(" ", text).lower().strip().encode()


def learn(labelled: DataFrame, *, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS, dictionary_bytes: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """A raw-content dictionary per language from rows ``(doc_id, lang, text)``, frequent languages first.

    The sample is bounded by the parameters: the documents with the lowest hash of their id, and the
    beginning of each. It and a count per language are all that comes to the driver. Rows with a null id, language
    or text, and texts without words teach nothing; repeated rows count once.
    """
    from pyspark.sql import Window

    known = picked(labelled, doc_id="doc_id", lang="lang", text="text").where("doc_id is not null and lang is not null and text is not null")
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    chosen = known.select("doc_id", "lang", F.xxhash64("doc_id", F.lit(17)).alias("h")).distinct()
    chosen = chosen.withColumn("n", F.row_number().over(order)).where(F.col("n") <= sample_docs).select("doc_id", "lang", "h")
    chosen = stored(chosen, "language-sample")
    rows = known.join(chosen, ["doc_id", "lang"]).select("lang", "h", F.substring("text", 1, sample_chars).alias("text")).distinct()
    parts: dict[str, list[tuple[int, str]]] = {}
    for row in stored(rows, "language-texts").collect():
        parts.setdefault(row.lang, []).append((row.h, row.text))
    model = {}
    seen = {row.lang: row["count"] for row in known.groupBy("lang").count().collect()}
    for lang, texts in sorted(parts.items(), key=lambda p: (-seen[p[0]], p[0])):
        content = b" ".join(letters(text) for _, text in sorted(texts))[:dictionary_bytes]
        if content.split():
            model[lang] = content
    if sum(map(len, model.values())) > MODEL_LIMIT:
        raise ValueError(f"{len(model)} languages need more than {MODEL_LIMIT} bytes of dictionaries")
    return model


def _compressors(model: dict[str, bytes], level: int) -> list:
    import zstandard

    made = []
    for content in model.values():
        content = content.ljust(16)  # zstd refuses shorter ones
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(level=level)
        made.append(zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_content_size=False, write_dict_id=False).compress)
    return made


def predict(docs: DataFrame, model: dict[str, bytes], *, id_column: str = "doc_id", text_column: str = "text", least_margin: float = LEAST_MARGIN) -> DataFrame:
    """``(doc_id, lang_pred, score, rejected)`` for every row, from the whole text and nothing else.

    A text is compressed in blocks, so that each block has the dictionary near. ``score`` is the
    share by which the second-smallest total exceeds the smallest; ``rejected`` marks narrow ones.
    Equal totals go to the language with the most labelled documents. Null texts and those without a letter (and all,
    if nothing was learned) are ``und`` with score 0. Repeated rows are predicted each for itself.
    Nothing is shuffled; the model is bounded by ``MODEL_LIMIT``.
    """
    docs = picked(docs, doc_id=id_column, text=text_column)
    kind = docs.schema["doc_id"].dataType.simpleString()
    languages = list(model)

    def run(batches: Batches) -> Batches:
        compressors = _compressors(model, LEVEL)
        for batch in batches:
            found, share = [], []
            for text in raw_bytes(batch.column("text")):
                text = letters(text.decode("utf-8", "replace"))
                if not languages or not text:
                    found.append(UNKNOWN)
                    share.append(0.0)
                    continue
                blocks = [text[i : i + BLOCK_BYTES] for i in range(0, len(text), BLOCK_BYTES)]
                sizes = np.array([sum(len(compress(b)) for b in blocks) for compress in compressors])
                best = int(sizes.argmin())
                found.append(languages[best])
                rest = np.delete(sizes, best)
                share.append(1.0 - sizes[best] / rest.min() if len(rest) else 1.0)
            share = np.array(share, np.float64)
            yield pa.record_batch(
                {"doc_id": batch.column("doc_id"), "lang_pred": pa.array(found, pa.string()), "score": pa.array(share), "rejected": pa.array(share < least_margin)}
            )

    return docs.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, rejected boolean")
