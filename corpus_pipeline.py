"""A corpus made ready for training: five stages over the documents, each written and read again by the next.

toxicity -> exact_dedup -> ngram_join -> sentence_spans -> packing
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldline.llm import exact_dedup, ngram_join, packing, sentence_spans, toxicity
from foldline.llm.shared import crc_bucket, written

#: Documents that score so high are rejected.
TOXIC = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; the lexicon is learned from labels whose crc32(doc_id) mod 4 is not 2."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, labels, crc_bucket(F.col("doc_id"), 4) != 2, TOXIC)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text (A-Z in lower case), the one with the largest id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each component under Jaccard similarity 0.8 of 5-word shingles."""
    return ngram_join.drop_similar(docs, words=5, percent=80)


def drop_repeated_sentences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without sentences that a non-first repeated span covers; n_chars follows the text."""
    kept = sentence_spans.drop_repeated_sentences(docs).drop("span_dedup")
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else kept


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens, filled with lexical neighbours."""
    return packing.digests(packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), window=4096))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("sentence_spans", drop_repeated_sentences),
    ("packing", pack),
]

#: The learned lexicon, components and retrieval have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents that the stages leave, each stage written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"stage-{name}")
    return docs
