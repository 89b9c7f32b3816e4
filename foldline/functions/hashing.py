"""Stateless md5 hash buckets: folds, hold-out splits, masks.

``bucket(key, salt, n) = int(first 8 hex digits of md5(salt || ':' || key)) mod n``
is computed per row with no shuffle, so it scales with the data and gives
the same answer in Spark and in DuckDB (``sql_bucket``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket(key: Column | str, salt: str, n: int) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(f"{salt}:"), key.cast("string")))
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return (h % F.lit(n)).cast("int")


def sql_bucket(key_sql: str, salt: str, n: int) -> str:
    """DuckDB spelling of :func:`bucket`."""
    return (f"CAST(CAST('0x' || substr(md5('{salt}:' || CAST({key_sql} AS VARCHAR)), 1, 8) AS BIGINT)"
            f" % {n} AS INTEGER)")


def sort_hash(key: Column | str, salt: str) -> Column:
    """Full md5 hex of ``salt:key``; a stable pseudo-random sort key."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{salt}:"), key.cast("string")))


def sql_sort_hash(key_sql: str, salt: str) -> str:
    return f"md5('{salt}:' || CAST({key_sql} AS VARCHAR))"
