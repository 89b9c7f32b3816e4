"""Exact top-k search of binary codes by incremental multi-index hashing.

A code is cut into segments; a table for each segment lists the codes by the
segment's value. A query probes the values within radius r of its own, one
segment after another. Once segments 1..j are probed at radius r and the rest at
r - 1, every code at distance below m * r + j (m segments) has been met; so the
search ends when the kth verified distance is below that.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldline.llm.shared import written

BITS = 64


def sign_code(vector: Column) -> Column:
    """64-bit code of a vector: bit i is set if element i is above 0; absent and null elements count as 0.

    A longer vector is an error: its neighbours would come from its first elements alone.
    """
    bit = lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i.cast("int"))).otherwise(F.lit(0).cast("long"))
    code = F.aggregate(F.transform(F.slice(vector, 1, BITS), bit), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))
    return F.when(F.size(vector) > BITS, F.raise_error(F.lit(f"a sign code holds {BITS} elements, a vector has more")).cast("long")).otherwise(code)


class SegmentTables:
    """The multi-index of one block of distinct codes."""

    def __init__(self, codes: np.ndarray, segments: int = 0):
        self.codes = codes
        count = segments or max(4, round(BITS / max(8.0, min(16.0, np.log2(len(codes) + 1)))))
        edges = [BITS * i // count for i in range(count + 1)]
        self.cuts = [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]
        self.tables = []
        for shift, width in self.cuts:
            value = self.value(codes, shift, width)
            order = np.argsort(value, kind="stable")
            self.tables.append((order, np.searchsorted(value[order], np.arange((1 << width) + 1))))
        self.masks: dict[tuple[int, int], np.ndarray] = {}

    @staticmethod
    def value(codes: np.ndarray, shift: int, width: int) -> np.ndarray:
        return ((codes >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64)

    def flips(self, width: int, radius: int) -> np.ndarray:
        if (width, radius) not in self.masks:
            self.masks[width, radius] = np.array([sum(1 << b for b in bits) for bits in combinations(range(width), radius)], np.int64)
        return self.masks[width, radius]

    def search(self, query: int, weights: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and distances of all codes no farther than the place where ``need`` rows (by weight) are covered."""
        query = np.uint64(query)
        own = [int(self.value(query, *cut)) for cut in self.cuts]
        seen = np.zeros(len(self.codes), bool)
        at, distance = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for radius in range(max(width for _, width in self.cuts) + 1):
            for j, ((_, width), (order, start)) in enumerate(zip(self.cuts, self.tables, strict=True)):
                if radius <= width:
                    probe = own[j] ^ self.flips(width, radius)
                    first, size = start[probe], start[probe + 1] - start[probe]
                    first, size = first[size > 0], size[size > 0]
                    if len(size):
                        met = order[np.arange(size.sum()) + np.repeat(first - np.cumsum(size) + size, size)]
                        met = met[~seen[met]]
                        seen[met] = True
                        at = np.concatenate([at, met])
                        distance = np.concatenate([distance, np.bitwise_count(self.codes[met] ^ query).astype(np.int64)])
                covered = len(self.cuts) * radius + j  # every code at this distance or nearer has been met
                near = distance <= covered
                if weights[at[near]].sum() >= need:
                    return at[near], distance[near]
        return at, distance


def top_k(rows: DataFrame, queries: DataFrame, k: int = 10, index_block: int = 1 << 14, query_block: int = 1 << 9) -> DataFrame:
    """(query_id, rank, row_id, distance): the k nearest rows of every query, itself left out, exactly.

    ``rows`` and ``queries`` have id and code (both long); rows with a null id
    or code take no part, repeated ids count once. Equal distances go to the
    smaller id; a query with fewer than k other rows has fewer results.

    Rows of one code are one entry that keeps its k + 1 smallest ids (no result
    needs more), chosen map-side. Entries and queries are dealt into blocks of
    about the given sizes by hash; each pair of blocks is one group, whose
    results, k for each query, are merged.
    """
    def clean(df: DataFrame) -> DataFrame:
        return df.select(F.col("id").cast("long").alias("id"), F.col("code").cast("long").alias("code")).dropna().dropDuplicates(["id"])

    first = Window.partitionBy("code").orderBy("id")
    ids = clean(rows).withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    entries = written(ids.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "codes")
    asked = written(clean(queries), "queries")
    n_index, n_query = (max(1, -(-df.count() // size)) for df, size in ((entries, index_block), (asked, query_block)))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = entries.withColumn("block", F.pmod(F.xxhash64("code"), F.lit(n_index))).withColumn("part", every(n_query))
    right = asked.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(n_query))).withColumn("block", every(n_index))

    def search(index: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int]] = []
        if len(index) and len(asked):
            tables = SegmentTables(index["code"].to_numpy(np.int64).view(np.uint64))
            members = index["ids"].to_list()
            weights = np.array([len(x) for x in members])
            for query, code in zip(asked["id"].tolist(), asked["code"].to_numpy(np.int64).view(np.uint64), strict=True):
                at, distance = tables.search(code, weights, k + 1)
                found = sorted((d, i) for a, d in zip(at.tolist(), distance.tolist(), strict=True) for i in members[a].tolist() if i != query)
                out += [(query, i, d) for d, i in found[:k]]
        return pd.DataFrame(out, columns=["query_id", "row_id", "distance"])

    pairs = left.groupBy("block", "part").cogroup(right.groupBy("block", "part"))
    found = pairs.applyInPandas(search, "query_id long, row_id long, distance int")
    best = Window.partitionBy("query_id").orderBy("distance", "row_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "row_id", "distance")

