"""Tables written to the shared folder, and small frame helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldline.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: later stages re-read files that every executor sees, so
    a lost executor costs a re-read only. ``options`` go to the writer.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, **options)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables that an operator needs until its result is written."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path, self.tables = spark, scratch_path(spark, name), 0

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self.tables += 1
        path = f"{self.path}/{self.tables}-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def result(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` beside the scratch tables, then delete these."""
        out = written(df, name)
        self.drop()
        return out

    def drop(self) -> None:
        """Delete the scratch tables."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def documents(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone; extra columns, whatever their names, are left out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n
