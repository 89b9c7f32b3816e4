"""Deep regression forests of all folds, tree by tree.

MLlib grows the trees of a forest together and keeps every node on the driver: 800
trees of depth 20 for each of five folds are hundreds of millions of objects there. Here
a task has the training rows of a fold in bins and grows some of its trees, one
after another; trees are written to ``spark.checkpoint.dir`` and never meet on the
driver. Like MLlib's: all rows train every tree, a third of the features (a category's values
counted one by one) is drawn for each node, best split by variance.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldline.operators.boosting import Binning, _pieces, fit_binning
from foldline.operators.preprocess import FoldPreprocessModel
from foldline.session import share_library, stored

#: Nodes up to which a forest is left to MLlib, tasks for each fold, and bytes of the rows that a task holds.
MLLIB_NODES, PARTS, FOREST_BYTES = 1 << 20, 8, 1 << 28
#: Gain below which a split counts as none: sums of a node are differences of running ones.
LEAST_GAIN = 1e-9


@dataclass(frozen=True)
class ForestParams:
    numTrees: int = 800
    maxDepth: int = 20
    min_child: int = 2
    maxBins: int = 64
    seed: int = 42


def _firsts(a: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))


def _gain(nl, gl, n, g, least: int):
    """What a split takes off the squared error; -1 if a side has fewer than ``least`` rows."""
    gain = gl * gl / np.maximum(nl, 1) + (g - gl) ** 2 / np.maximum(n - nl, 1) - g * g / np.maximum(n, 1)
    return np.where((nl < least) | (n - nl < least), -1.0, gain)


def _cells(slot: np.ndarray, x: np.ndarray, y: np.ndarray, bins: int, n: int):
    """(cell, rows, sum of y) of each (slot, bin) that has rows, in order."""
    key = slot * bins + x
    if n * bins <= 4 * len(key):
        count, total = np.bincount(key, minlength=n * bins), np.bincount(key, weights=y, minlength=n * bins)
        cells = np.flatnonzero(count)
        return cells, count[cells], total[cells]
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = _firsts(key)
    return key[at], np.diff(np.append(at, len(key))), np.add.reduceat(y[order], at)


def grow(x: np.ndarray, y: np.ndarray, sizes: np.ndarray, categorical: np.ndarray, p: ForestParams, rng: np.random.Generator) -> tuple:
    """A tree as arrays (feature, threshold, left child or -1, mean); the right child comes after the left one."""
    features = [(j, v) for j in range(len(sizes)) for v in (range(1, int(sizes[j]) + 1) if categorical[j] else [None])]
    take = max(1, -(-len(features) // 3))
    feature, threshold, left, value = ([np.zeros(1, t)] for t in (np.int16, np.int32, np.int32, float))
    left[0][:], value[0][:] = -1, y.mean() if len(y) else 0.0
    rows, slot, n, total = np.arange(len(y)), np.zeros(len(y), np.intp), 1, 1
    for _ in range(p.maxDepth):
        count, s = np.bincount(slot, minlength=n), np.bincount(slot, weights=y[rows], minlength=n)
        draw = rng.random((n, len(features)), np.float32)
        drawn = (draw <= np.partition(draw, take - 1, 1)[:, take - 1:take]) & (count >= 2 * p.min_child)[:, None]
        best, at_feature, at_bin = np.full(n, LEAST_GAIN), np.full(n, -1), np.zeros(n, np.intp)
        for e, (j, v) in enumerate(features):
            nodes = np.flatnonzero(drawn[:, e])
            if not len(nodes):
                continue
            place = np.full(n, -1)
            place[nodes] = np.arange(len(nodes))
            own = place[slot]
            at = np.flatnonzero(own >= 0)
            own, xs, ys = own[at], x[j][rows[at]], y[rows[at]]
            if v is not None:
                is_v = xs == v
                nl, gl = np.bincount(own[is_v], minlength=len(nodes)), np.bincount(own[is_v], weights=ys[is_v], minlength=len(nodes))
                gain, where = _gain(nl, gl, count[nodes], s[nodes], p.min_child), v
            else:
                bins = int(sizes[j]) + 1
                cells, c, g = _cells(own, xs, ys, bins, len(nodes))
                seg = cells // bins
                first, nl, gl = _firsts(seg), np.cumsum(c), np.cumsum(g)
                nl, gl = nl - (nl[first] - c[first])[seg], gl - (gl[first] - g[first])[seg]
                each = _gain(nl, gl, count[nodes][seg], s[nodes][seg], p.min_child)
                gain = np.maximum.reduceat(each, first)
                hits = np.flatnonzero(each == gain[seg])[::-1]
                where = np.empty(len(nodes), np.intp)
                where[seg[hits]] = cells[hits] % bins  # the first of equal ones stays
            better = gain > best[nodes]
            best[nodes[better]], at_feature[nodes[better]] = gain[better], j
            at_bin[nodes[better]] = where if v is not None else where[better]
        split = np.flatnonzero(at_feature >= 0)
        if not len(split):
            break
        feature[-1][split], threshold[-1][split], left[-1][split] = at_feature[split], at_bin[split], total + 2 * np.arange(len(split))
        place = np.full(n, -1)
        place[split] = np.arange(len(split))
        at = np.flatnonzero(place[slot] >= 0)
        rows, slot = rows[at], slot[at]
        go = _left(x[at_feature[slot], rows], at_bin[slot], categorical[at_feature[slot]])
        slot, n = 2 * place[slot] + ~go, 2 * len(split)
        total += n
        for column, fill, t in ((feature, 0, np.int16), (threshold, 0, np.int32), (left, -1, np.int32)):
            column.append(np.full(n, fill, t))
        value.append(np.bincount(slot, weights=y[rows], minlength=n) / np.bincount(slot, minlength=n))
    return tuple(np.concatenate(c) for c in (feature, threshold, left, value))


def _left(v: np.ndarray, threshold: np.ndarray, categorical: np.ndarray) -> np.ndarray:
    return np.where(categorical, v == threshold, v <= threshold)


def predict(tree: tuple, x: np.ndarray, categorical: np.ndarray) -> np.ndarray:
    """The mean of the leaf that each row of ``x`` (a line for each feature) ends in."""
    feature, threshold, left, value = tree
    node, rows = np.zeros(x.shape[1], np.intp), np.arange(x.shape[1])
    while len(rows):
        at = node[rows]
        inner = left[at] >= 0
        rows, at = rows[inner], at[inner]
        j = feature[at]
        node[rows] = left[at] + ~_left(x[j, rows], threshold[at], categorical[j])
    return value[node]


def _imputed(x: np.ndarray, fills: np.ndarray) -> np.ndarray:
    """Bins with the fold's median or mode in place of missing values."""
    return np.where(x == 0, fills[:, None].astype(x.dtype), x)


@dataclass
class ForestFolds:
    """The forests of all folds; ``trees`` has a row (part, data) for each tree, part // PARTS is its fold."""
    binning: Binning
    trees: DataFrame
    params: ForestParams
    k: int
    fold_col: str = "fold"

    def attach(self, df: DataFrame, out_col: str, own_fold: bool) -> DataFrame:
        """``df`` with a prediction: by the forest that didn't see the row's fold, or the mean of all forests.

        Rows in bins go to each part of the forests; its sums are added up for each row.
        """
        share_library(df.sparkSession)
        binning, k, n_parts = self.binning, self.k, self.k * PARTS
        rows = stored(df.withColumn("_row", F.monotonically_increasing_id()))
        fold = F.coalesce(F.col(self.fold_col).cast("int"), F.lit(-1)) if own_fold else F.lit(-1)

        def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if len(b):
                    yield pa.RecordBatch.from_pydict({"row": [b["_row"].to_numpy().tobytes()], "fold": [b["_fold"].to_numpy().tobytes()], "x": [binning.codes(b).tobytes()]},
                                                     pa.schema([(c, pa.binary()) for c in ("row", "fold", "x")]))

        def sums(part: int, both: Iterator) -> Iterator[tuple]:
            f, trees, held = part // PARTS, [], []
            for _, (data, piece) in both:
                (held if data is None else trees).append(piece if data is None else pickle.loads(data))
            for row, own, x in held:
                row, x = np.frombuffer(row, np.int64), np.frombuffer(x, binning.dtype).reshape(len(binning.sizes), -1)
                at = np.flatnonzero(np.frombuffer(own, np.int32) == f) if own_fold else np.arange(len(row))
                x = _imputed(x[:, at], binning.fills[f])
                total = np.zeros(len(at))
                for tree in trees:
                    total += predict(tree, x, binning.is_categorical)
                yield from zip(row[at].tolist(), total.tolist(), strict=True)

        binned = binning.inputs(rows, ["_row", fold.alias("_fold")]).mapInArrow(pieces, "row binary, fold binary, x binary")
        asked = binned.rdd.flatMap(lambda r: [(q, (None, tuple(r))) for q in range(n_parts)]).union(self.trees.rdd.map(lambda r: (r["part"], (r["data"], None))))
        found = asked.partitionBy(n_parts, lambda q: q).mapPartitionsWithIndex(sums)
        total = df.sparkSession.createDataFrame(found, "_row long, _sum double").groupBy("_row").agg(F.sum("_sum").alias("_sum"))
        n_trees = float(self.params.numTrees * (1 if own_fold else k))
        return rows.join(total, "_row", "left").select(*df.columns, (F.col("_sum") / F.lit(n_trees)).alias(out_col))


def fit_forest(train: DataFrame, prep: FoldPreprocessModel, p: ForestParams, id_col: str, label: str = "label", fold_col: str = "fold", k: int = 5) -> ForestFolds | None:
    """The ``k`` forests, or None if a task can't hold the rows. Rows without a label take no part."""
    rows = train.where(F.col(label).isNotNull() & F.col(fold_col).isNotNull())
    binning = fit_binning(rows, prep, id_col, k, p.maxBins)
    binned, n = _pieces(rows, binning, id_col, label, fold_col)
    if not len(binning.sizes) or n * (len(binning.sizes) * np.dtype(binning.dtype).itemsize + 64) > FOREST_BYTES:
        return None
    trees = binned.sparkSession.createDataFrame(
        binned.rdd.flatMap(lambda r: [(q, tuple(r[c] for c in ("key", "fold", "label", "x"))) for q in range(k * PARTS)])
        .partitionBy(k * PARTS, lambda q: q).mapPartitionsWithIndex(_grower(binning, p)), "part int, data binary")
    return ForestFolds(binning, stored(trees), p, k, fold_col)


def _grower(binning: Binning, p: ForestParams):
    """The trees of a part, each from its own random numbers over the training rows in the order of their keys."""
    def run(part: int, both: Iterable) -> Iterator[tuple]:
        f, held = part // PARTS, [r for _, r in both]
        if not held:
            return
        key, fold, y = (np.concatenate([np.frombuffer(r[i], t) for r in held]) for i, t in enumerate((np.int64, np.int32, float)))
        x = np.concatenate([np.frombuffer(r[3], binning.dtype).reshape(len(binning.sizes), -1) for r in held], 1)
        own = np.flatnonzero(fold != f)
        own = own[np.argsort(key[own], kind="stable")]
        x, y = _imputed(x[:, own], binning.fills[f]), y[own]
        for tree in range(part % PARTS, p.numTrees, PARTS):
            yield part, pickle.dumps(grow(x, y, binning.sizes, binning.is_categorical, p, np.random.default_rng([p.seed, f, tree])), protocol=5)
    return run
