"""Readers for the parquet tables and the order frame built from them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``spark.read.parquet``; callers select columns so only those are scanned."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def cents(c: str):
    """A two-decimal amount as exact integer cents."""
    return F.round(F.col(c) * F.lit(100.0)).cast("bigint")


def line_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem aggregated per order (partial aggregation before the shuffle).

    Money and discounts are summed as integer cents, so the sums do not
    depend on the order in which partitions are combined (floating sums do,
    in the last bit); one final division gives the same double everywhere.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_quantity", "l_discount", "l_extendedprice", "l_shipdate")
    agg = li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("l_quantity").alias("qty"),
        F.sum(cents("l_discount")).alias("_disc_cents"),
        F.sum(cents("l_extendedprice")).alias("_ext_cents"),
        F.max("l_shipdate").alias("sd"),
        F.min("l_shipdate").alias("sd_first"),
    )
    return agg.select(
        "l_orderkey", "n_lines", "qty",
        (F.col("_disc_cents").cast("double") / (F.lit(100.0) * F.col("n_lines"))).alias("disc"),
        (F.col("_ext_cents").cast("double") / F.lit(100.0)).alias("ext"),
        "sd", "sd_first")


def order_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders JOIN customer LEFT JOIN (lineitem per order).

    Orders without lineitems keep NULL line columns: the natural missing
    values the imputers work on. Join strategies are left to AQE (the
    customer side is broadcast only when its runtime size is under the
    threshold; otherwise both sides are shuffled on the key).
    """
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority")
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    lines = line_summary(spark, sf_dir)
    return (o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
            .join(c, o.o_custkey == c.c_custkey)
            .drop("o_custkey", "c_custkey", "l_orderkey"))


ORDER_FRAME_SQL = """
SELECT o.o_orderkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority,
       c.c_nationkey, c.c_acctbal, c.c_mktsegment,
       l.n_lines, l.qty, l.disc, l.ext, l.sd, l.sd_first
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN (SELECT l_orderkey, n_lines, qty, CAST(disc_cents AS DOUBLE) / (100.0 * n_lines) AS disc,
                  CAST(ext_cents AS DOUBLE) / 100.0 AS ext, sd, sd_first
           FROM (SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS qty,
                        sum(CAST(round(l_discount * 100.0) AS BIGINT)) AS disc_cents,
                        sum(CAST(round(l_extendedprice * 100.0) AS BIGINT)) AS ext_cents,
                        max(l_shipdate) AS sd, min(l_shipdate) AS sd_first
                 FROM lineitem GROUP BY l_orderkey) la) l ON l.l_orderkey = o.o_orderkey
"""
