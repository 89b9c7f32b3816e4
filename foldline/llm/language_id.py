"""Language identification by compression: the dictionary that shortens a text most names its language."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldline.llm.shared import written

UNKNOWN = "und"


def learn_dictionaries(docs: DataFrame, usable: Column, per_language: int = 400, dictionary_bytes: int = 1 << 16) -> dict[str, bytes]:
    """A raw-content dictionary for each non-null ``lang`` of the usable rows.

    Fitted on a bounded sample: of each language the ``per_language`` rows with
    the smallest hash of their id; an equal share of ``dictionary_bytes`` from
    the middle of each, in lower case, makes the dictionary. The share is that of
    the rows chosen, so a language of few rows has long pieces of them.
    Rows with null or empty text teach nothing; without any row there is no
    dictionary. Needs doc_id, text and lang; other columns are ignored.
    """
    rows = docs.select("doc_id", "lang", "text").where(usable & F.col("lang").isNotNull() & (F.length("text") > 0))
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = written(rows.select("doc_id", "lang").withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_language), "chosen")  # per_language ids a language
    shares = chosen.groupBy("lang").agg(F.floor(F.lit(dictionary_bytes) / F.count(F.lit(1))).cast("int").alias("share"))
    middle = F.greatest(F.lit(1), F.floor((F.length("text") - F.col("share")) / 2).cast("int") + 1)
    texts = (rows.join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi").join(F.broadcast(shares), "lang")
             .select("lang", "doc_id", F.lower(F.substring("text", middle, F.col("share"))).alias("text")).orderBy("lang", "doc_id").collect())
    by_language: dict[str, list[bytes]] = {}
    for row in texts:
        by_language.setdefault(row.lang, []).append(row.text.encode())
    out = {}
    for lang, parts in by_language.items():
        raw = b"\n".join(parts)
        out[lang] = raw.ljust(64)  # a raw-content dictionary has 8 bytes at least
    return out


@functools.lru_cache(maxsize=2)
def compressors(dictionaries: tuple[tuple[str, bytes], ...], level: int) -> list[zstandard.ZstdCompressor]:
    """A worker's compressors, kept for its later tasks."""
    out = []
    for _, raw in dictionaries:
        learned = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        learned.precompute_compress(level=level)
        out.append(zstandard.ZstdCompressor(level=level, dict_data=learned, write_checksum=False, write_content_size=True))
    return out


def identify(docs: DataFrame, dictionaries: dict[str, bytes], level: int = 6, block: int = 2048,
             min_margin: float = 0.002) -> DataFrame:
    """One row per document: doc_id, lang_pred, score, accepted.

    Every whole text, in lower case, is compressed with each language's
    dictionary, ``block`` bytes at a time so that the dictionary stays what
    matches are drawn from to the end of a long text; the smallest sum wins, ties go to the language that sorts first. ``score``
    is 1 - (best / second best) ** 8, in 0 to 1. A text whose best size is not
    smaller than the second by ``min_margin`` of it is rejected: it keeps its
    best guess, and ``accepted`` is false. Null texts and texts without a
    letter, or any text if no language was learned, are ``und`` with score 0.
    Rows may repeat; other columns are ignored.
    """
    known = tuple(sorted(dictionaries.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = compressors(known, level)
        for batch in batches:
            texts = batch.column(1)
            letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_pylist()
            names, scores, sure = [], [], []
            for value, spoken in zip(pc.utf8_lower(texts).cast(pa.binary()), letters, strict=True):
                if not (spoken and tools):
                    names.append(UNKNOWN), scores.append(0.0), sure.append(False)
                    continue
                raw = memoryview(value.as_buffer())
                blocks = [raw[i:i + block] for i in range(0, len(raw), block)]
                sizes = np.array([sum(len(c.compress(x)) for x in blocks) for c in tools], float)
                order = np.argsort(sizes, kind="stable")
                ratio = sizes[order[0]] / sizes[order[1]] if len(order) > 1 else 0.0
                names.append(known[order[0]][0]), scores.append(1 - ratio ** 8), sure.append(1 - ratio >= min_margin)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(sure, pa.bool_())],
                                             ["doc_id", "lang_pred", "score", "accepted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, accepted boolean")
