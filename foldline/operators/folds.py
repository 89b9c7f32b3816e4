"""Fold assignment for cross-validation.

``hash_fold`` is stateless (a per-row md5 bucket, no shuffle) and is the
default. ``balanced_fold`` gives fold sizes that differ by at most one, as
``ntile(k)`` over a seeded hash order does, using distributed global
positions instead of a single-partition window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldline.functions.hashing import bucket, sort_hash
from foldline.operators.quantiles import global_positions


def hash_fold(df: DataFrame, id_col: str, k: int = 5, seed: int = 42,
              out_col: str = "fold") -> DataFrame:
    return df.withColumn(out_col, bucket(F.col(id_col), str(seed), k))


def ntile_bucket(pos, n, k: int):
    """0-based ``ntile(k)`` bucket of 0-based position ``pos`` among ``n`` rows."""
    q = F.floor(n / F.lit(k))
    rem = n - q * F.lit(k)
    big = (q + 1) * rem
    return F.when(pos < big, F.floor(pos / (q + 1))) \
        .otherwise(rem + F.floor((pos - big) / q)).cast("int")


def balanced_fold(df: DataFrame, id_col: str, k: int = 5, seed: int = 42,
                  out_col: str = "fold") -> DataFrame:
    keyed = df.withColumn("_h", sort_hash(F.col(id_col), str(seed)))
    pos = global_positions(keyed, "_h")
    return (pos.withColumn(out_col, ntile_bucket(F.col("_pos"), F.col("_total"), k))
            .drop("_h", "_pos", "_total"))
