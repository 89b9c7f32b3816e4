"""Hard negatives: for each anchor and positive, the best-scoring rows of other labels that are nearly as close.

Segment summary filtering: every vector is stored with the mean and the deviation
of its segments, at one, four and sixteen segments. A segment's share of an inner
product lies within length * (product of means plus or minus product of
deviations), so the sums over segments bound the score from both sides. Pairs that
can't enter a result any more go at the coarsest level that shows it; only what
passes the finest is scored exactly.

Anchors are the stated query set. They are taken in blocks of bounded bytes; the
rows stay where they are and are scanned twice for each block, once for positives
and once for negatives. Each task keeps the best rows of each query, whose bound
rises as it reads, and the bests are merged by query.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldline.llm.shared import Scratch

#: Numbers of segments, from coarse to fine.
LEVELS = (1, 4, 16)
#: Bytes of anchors (8 for a component) that are broadcast at once.
ANCHOR_BYTES = 8 << 20
#: Rows and anchors compared at once in a task.
TILE = 1 << 11
_BEST = "query long, id long, score long"


def scaled(vector: Column, by: int = 256) -> Column:
    """floor(by * x) of every component as long; null for vectors with a null or non-finite component, and null ones."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(good, F.transform(vector, lambda x: F.floor(x.cast("double") * by).cast("long")))


def _edges(size: int, segments: int) -> np.ndarray:
    return np.array([size * i // segments for i in range(segments + 1)])


def summaries(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations (population) of the segments of every level, side by side."""
    means, deviations = [], []
    for segments in LEVELS:
        edges = _edges(v.shape[1], segments)
        for a, b in zip(edges, edges[1:], strict=False):
            part = v[:, a:b].astype(float) if b > a else np.zeros((len(v), 1))
            means.append(part.mean(1))
            deviations.append(part.std(1))
    return np.stack(means, 1), np.stack(deviations, 1)


def _summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their summaries; refuses components whose products don't fit a long."""
    for batch in batches:
        at = batch["vector"].value_lengths().to_numpy(zero_copy_only=False)
        values = batch["vector"].flatten().to_numpy(zero_copy_only=False)
        starts = np.cumsum(at) - at
        for size in np.unique(at).tolist():
            rows = np.flatnonzero(at == size)
            v = values[starts[rows][:, None] + np.arange(size)] if size else np.zeros((len(rows), 0), np.int64)
            if size and (np.abs(v.astype(float)).max() ** 2) * size >= 2.0 ** 62:
                raise ValueError(f"a scaled component is too large: products of {size} components must stay below 2^62")
            means, deviations = summaries(v)
            columns = {k: batch[k].take(pa.array(rows)) for k in ("id", "label", "vector")}
            columns |= {k: pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * x.shape[1], x.ravel()) for k, x in (("means", means), ("deviations", deviations))}
            yield pa.RecordBatch.from_pydict(columns)


def index(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``rows`` (id, label, vector of longs) with segment summaries, written; rows with a null in any of them take no part."""
    kept = rows.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), "vector").dropna()
    return scratch.write(kept.mapInArrow(_summarised, "id long, label long, vector array<long>, means array<double>, deviations array<double>"), "vectors")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


class Block:
    """Rows or anchors of one length."""

    def __init__(self, ids, labels, v, means, deviations):
        self.ids, self.labels, self.v, self.means, self.deviations = ids, labels, v, means, deviations
        self.norm = np.sqrt((v.astype(float) ** 2).sum(1))

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> dict[int, Block]:
        """By number of components."""
        at, out = batch["vector"].value_lengths().to_numpy(zero_copy_only=False), {}
        for size in np.unique(at).tolist():
            part = batch if (at == size).all() else batch.filter(pa.array(at == size))
            width = sum(LEVELS)
            out[size] = cls(*(part[k].to_numpy(zero_copy_only=False) for k in ("id", "label")), _matrix(part["vector"], size) if size else np.zeros((len(part), 0), np.int64),
                            _matrix(part["means"], width), _matrix(part["deviations"], width))
        return out

    def take(self, at: np.ndarray) -> Block:
        return Block(self.ids[at], self.labels[at], self.v[at], self.means[at], self.deviations[at])


def bounds(anchors: Block, rows: Block, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest possible score of every anchor with every row, from the summaries of one level."""
    cut = slice(sum(LEVELS[:level]), sum(LEVELS[:level + 1]))
    length = np.diff(_edges(anchors.v.shape[1], LEVELS[level])).astype(float)
    middle = (anchors.means[:, cut] * length) @ rows.means[:, cut].T
    spread = (anchors.deviations[:, cut] * length) @ rows.deviations[:, cut].T
    spread += 1e-9 * np.outer(anchors.norm, rows.norm) + 1e-3  # more than the sums can be off by rounding
    return middle - spread, middle + spread


def survivors(anchors: Block, rows: Block, allowed: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor and row positions and exact scores of all allowed pairs that may score within low..high of their anchor.

    Level after level, anchors and rows without a pair left drop out of the next, finer comparison.
    """
    a, r = np.arange(len(anchors.ids)), np.arange(len(rows.ids))
    for level in range(len(LEVELS)):
        least, most = bounds(anchors.take(a), rows.take(r), level)
        allowed &= (most >= low[a, None]) & (least <= high[a, None])
        keep_a, keep_r = allowed.any(1), allowed.any(0)
        a, r, allowed = a[keep_a], r[keep_r], allowed[keep_a][:, keep_r]
        if not len(a):
            break
    at, to = np.nonzero(allowed) if len(a) else (np.zeros(0, np.int64),) * 2
    at, to = a[at], r[to]
    score = [np.einsum("ij,ij->i", anchors.v[at[i:i + (1 << 16)]], rows.v[to[i:i + (1 << 16)]]) for i in range(0, len(at), 1 << 16)]
    return at, to, np.concatenate(score) if score else np.zeros(0, np.int64)


class Best:
    """The first k rows, by score downwards and then id, of each of n queries."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.query = self.id = self.score = np.zeros(0, np.int64)
        self.kth = np.full(n, -np.inf)

    def add(self, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        if not len(query):
            return
        query, ids, score = (np.concatenate(x) for x in ((self.query, query), (self.id, ids), (self.score, score)))
        order = np.lexsort((ids, -score, query))
        place = np.arange(len(query)) - np.searchsorted(query[order], query[order])
        order, place = order[place < self.k], place[place < self.k]
        self.query, self.id, self.score = query[order], ids[order], score[order]
        full = place == self.k - 1
        self.kth[self.query[full]] = self.score[full]

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"query": self.query, "id": self.id, "score": self.score})


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Block]]:
    for batch in batches:
        for start in range(0, len(batch), TILE):
            yield from Block.of(batch.slice(start, TILE)).items()


def _positives(shared, k: int):
    """The best k other rows of each anchor's own label, in one partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: dict[int, tuple[np.ndarray, Block]] = shared.value
        best = Best(sum(len(x[0]) for x in anchors.values()), k)
        for size, rows in _tiles(batches):
            number, all_ = anchors.get(size, (None, None))
            if number is None:
                continue
            for start in range(0, len(number), TILE):
                own, some = number[start:start + TILE], all_.take(np.arange(start, min(start + TILE, len(number))))
                allowed = (some.labels[:, None] == rows.labels) & (some.ids[:, None] != rows.ids)
                at, to, score = survivors(some, rows, allowed, best.kth[own], np.full(len(own), np.inf))
                best.add(own[at], rows.ids[to], score)
        if len(best.query):
            yield best.batch()
    return run


def _negatives(shared, k: int, low: int, high: int):
    """The best k rows of another label for each anchor and positive, among those in range, in one partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, first, positive = shared.value  # the positives of anchor i are first[i]..first[i + 1]
        best = Best(len(positive), k)
        has = np.flatnonzero(np.diff(first))
        if not len(has):
            return
        least, most, top = low * positive / 100.0, high * positive / 100.0, np.zeros(len(first))
        top[has] = np.maximum.reduceat(most, first[has])
        for size, rows in _tiles(batches):
            number, all_ = anchors.get(size, (None, None))
            if number is None:
                continue
            for start in range(0, len(number), TILE):
                own = number[start:start + TILE]
                asked = np.flatnonzero(first[own + 1] > first[own])
                if not len(asked):
                    continue
                own, some = own[asked], all_.take(start + asked)
                need = np.zeros(len(first))
                need[has] = np.minimum.reduceat(np.maximum(least, best.kth), first[has])
                allowed = some.labels[:, None] != rows.labels
                at, to, score = survivors(some, rows, allowed, need[own] - 1e-3, top[own] + 1e-3)
                count = first[own[at] + 1] - first[own[at]]
                pair = np.repeat(np.arange(len(at)), count)
                query = np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count) + first[own[at]][pair]
                fits = (low * positive[query] <= 100 * score[pair]) & (100 * score[pair] <= high * positive[query])
                best.add(query[fits], rows.ids[to[pair[fits]]], score[pair[fits]])
        if len(best.query):
            yield best.batch()
    return run


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first k of each query over all partitions."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, anchor_bytes: int = 0) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor of ``rows`` (id, label, vector of longs).

    Scores are integer inner products; higher ones come first, ties by the
    smaller id. An anchor's positives are its first ``positives`` other rows (of
    another id) of its label; the negatives of each are the first ``negatives``
    rows of another label with low * positive <= 100 * negative <= high * positive.
    ``anchor`` says, over id, label and vector, which rows are anchors.

    Rows with a null id, label or vector take no part. Rows that repeat an id
    are rows of their own, anchors as well. Vectors meet those of their own length
    only. Components whose products could pass 2^62 are an error. An empty table
    gives no rows; further columns count for nothing.

    A block of anchors has at most ``anchor_bytes`` (8 MB) of components, checked
    by an aggregate; it and its positives go through the driver to every task.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark, "negatives")
    stored = index(rows, scratch)
    asked = stored.where(anchor)
    bytes_ = asked.agg(F.coalesce(F.sum(8 * F.size("vector") + 16 * sum(LEVELS)), F.lit(0))).first()[0]
    blocks = max(1, -(-bytes_ // (anchor_bytes or ANCHOR_BYTES)))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id", "vector"), F.lit(blocks)))
    asked = scratch.write(asked, "anchors") if blocks > 1 else asked
    out = []
    for block in range(blocks):
        table = asked.where(F.col("block") == block).drop("block").orderBy("id", "label", "vector").toArrow()
        if not len(table):
            continue
        ids, anchors, base = table["id"].to_numpy(), {}, 0
        sizes = table["vector"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
        for size, part in Block.of(table.combine_chunks().to_batches()[0]).items():
            anchors[size] = (np.flatnonzero(sizes == size), part)
        shared = spark.sparkContext.broadcast(anchors)
        found = _first(stored.mapInArrow(_positives(shared, positives), _BEST), positives).orderBy("query", "rank").toArrow()
        of, positive = found["query"].to_numpy(), found["score"].to_numpy()
        first = np.searchsorted(of, np.arange(len(ids) + 1))
        pairs = spark.sparkContext.broadcast((anchors, first, positive))
        best = _first(stored.mapInArrow(_negatives(pairs, negatives, low, high), _BEST), negatives)
        names = spark.createDataFrame(pa.table({"query": np.arange(len(of)), "anchor_id": ids[of], "positive_id": found["id"], "positive_score": found["score"]}))
        out.append(scratch.write(best.join(names, "query").select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                                                                  "positive_score", F.col("score").alias("negative_score")), "block"))
        shared.unpersist()
        pairs.unpersist()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return scratch.result(reduce(DataFrame.unionByName, out) if out else spark.createDataFrame([], schema), "negatives")
