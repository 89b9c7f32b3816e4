"""Exact deduplication over a persistent digest index.

The index is a Parquet table bucketed and sorted by digest. A batch of new
rows is reduced to one row a digest, compared with the index by a sort-merge
anti-join (the index side needs no shuffle: its buckets are the partitions)
and what is new is appended. Batches that arrive later never replace a digest
that the index already holds, so the caller orders them.
"""

from __future__ import annotations

import uuid
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldline.llm.shared import Scratch, ascii_lower, documents, written

_ENTRY = "text_sha256 STRING, keep_id BIGINT, keep_row BIGINT, run STRING"


class DigestIndex:
    """A table (text_sha256, keep_id, keep_row, run) at ``path``; an existing one is opened again.

    ``buckets`` must be the number that the table was made with; at 100 TB some
    thousands keep a bucket of digests within a task's memory.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 48):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {self.table} ({_ENTRY}) USING parquet CLUSTERED BY (text_sha256) "
                  f"SORTED BY (text_sha256) INTO {buckets} BUCKETS LOCATION '{path}'")

    def entries(self) -> DataFrame:
        return self.spark.table(self.table)

    def close(self) -> None:
        """Take the table out of the catalog; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def add(self, digests: DataFrame, run: str) -> None:
        """Append the digests of (text_sha256, doc_id, row_no) that the index lacks, as those of ``run``.

        Of the rows of one digest the one with the largest (doc_id, row_no)
        stands for it; a null id counts as the smallest.
        """
        best = F.max(F.struct("doc_id", "row_no"))
        fresh = (digests.groupBy("text_sha256").agg(best.alias("best"))
                 .select("text_sha256", F.col("best.doc_id").alias("keep_id"), F.col("best.row_no").alias("keep_row"), F.lit(run).alias("run")))
        new = fresh.join(self.entries().hint("merge"), "text_sha256", "left_anti")
        new.repartition(self.buckets, "text_sha256").write.insertInto(self.table)


def text_digests(docs: DataFrame) -> DataFrame:
    """(row_no, doc_id, text_sha256): SHA-256 of each whole text after lower-casing A-Z; null is empty."""
    text = ascii_lower(F.coalesce("text", F.lit("")))
    return documents(docs).select(F.monotonically_increasing_id().alias("row_no"), "doc_id",
                                  F.sha2(text.cast("binary"), 256).alias("text_sha256"))


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None, batches: int = 2) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null equals empty.
    Of equal texts the row with the largest doc_id stays; of rows that repeat
    that id, one of them. Rows without an id lose against any id. An empty
    table gives no rows; other columns are ignored.

    The rows go into the index in ``batches`` of descending ids, so that the
    first row of a digest to arrive is the one that stays. With an ``index``
    from earlier runs, texts it holds already keep its row, and none of the
    new rows stays, also if they are the very rows added before. An index made
    here goes once the result's groups are written.
    """
    spark = docs.sparkSession
    rows = written(text_digests(docs), "digests")
    own, run = Scratch(spark, "digest-index"), uuid.uuid4().hex
    entries_of = index or DigestIndex(spark, f"{own.path}/index")
    low, high = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    number = "decimal(20,0)"  # ids may lie more than 2^63 apart
    step = F.lit(Decimal(1 if low is None else (high - low) // batches + 1)).cast(number)
    batch = F.coalesce(F.floor((F.lit(Decimal(high or 0)).cast(number) - F.col("doc_id").cast(number)) / step).cast("int"), F.lit(batches - 1))
    for k in range(batches):
        entries_of.add(rows.where(batch == k), run)
    sizes = rows.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("group_size"))
    entries = spark.read.schema(_ENTRY).parquet(entries_of.path)
    groups = written(sizes.join(entries, "text_sha256"), "digest-groups")
    if index is None:
        entries_of.close()
        own.drop()
    return rows.join(groups, "text_sha256").select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("row_no") == F.col("keep_row")) & F.col("run").eqNullSafe(F.lit(run))).alias("kept"),
        "text_sha256")


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not a copy of one with a larger doc_id.

    Rows that repeat an id share its fate; rows without an id stay.
    """
    gone = (exact_dedup(docs).groupBy("doc_id").agg(F.max("kept").alias("kept"))
            .where(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id"))
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
