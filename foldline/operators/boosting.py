"""Gradient-boosted trees for all folds at once, with patience.

A row of fold ``f`` trains the models of the other folds and judges the model
of its own. The binned rows lie in blocks of arrays and carry one running
prediction per fold model, so one pass over them serves the ``k`` ensembles together:

* each level of a round is one job. Tasks add up gradient histograms of their
  rows, a (fold, feature) histogram is summed by one task, which also finds its
  best splits, and the driver gets a few numbers for each tree node;
* the first job of a round applies the trees of the last one and sums the
  held-out error, which is the error of that prefix of the ensemble. A fold stops
  when ``patience`` rounds brought no better one, and keeps its best prefix;
* running predictions are persisted for a round, and written to
  ``spark.checkpoint.dir`` every ``CUT`` rounds.

A table of up to ``ALONE_BYTES`` needs no job for a level: a task for each fold has
all rows and grows the fold's whole ensemble (``Alone``), the same trees in one job.

Trees grow level by level, best first up to a number of leaves, or symmetric
(one split for a whole level). Numeric columns are binned by quantiles; a
category is split off one value at a time, as a tree on one-hot columns does,
without the columns. Missing values go where the fold's median or mode goes, so
the per-fold imputation costs nothing per row. Gradients are multiples of 2^-30:
sums below 2^23 don't depend on their order, and a fit repeats exactly.
"""

from __future__ import annotations

import heapq
import math
from array import array
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldline.operators.preprocess import FoldPreprocessModel, fold_medians
from foldline.session import ensure_checkpoint_dir, share_library, stored

#: Rounds after which the running predictions are written.
CUT = 25
#: Rows of a part of the state.
LEAST_ROWS, MOST_ROWS = 1 << 14, 1 << 21
#: Rows of a block, and of the pieces that are dealt out.
BLOCK_ROWS, PIECE_ROWS = 1 << 14, 1 << 10
#: Combinations of bins that are summed together.
CELLS = 512
#: Bytes up to which one task holds all rows, for the ensemble of one fold; rows that it sums at a time.
ALONE_BYTES, CHUNK_ROWS = 1 << 28, 1 << 16


@dataclass(frozen=True)
class BoostParams:
    """``leaves`` None: every split of a level; ``patience`` None: all rounds. Penalties act on the leaf values."""
    rounds: int = 1000
    step: float = 0.1
    depth: int = 4
    leaves: int | None = None
    symmetric: bool = False
    loss: str = "squared"          # squared | absolute
    subsample: float = 1.0
    colsample: float = 1.0
    l1: float = 0.0
    l2: float = 0.0
    min_gain: float = 0.0
    min_child: float = 1.0
    bagging_temperature: float = 0.0
    patience: int | None = 100
    max_bins: int = 64
    seed: int = 42


@dataclass
class Tree:
    """Nodes as parallel lists; a leaf has ``left`` -1. Rows whose bin is at most (numeric) or equal to the threshold go left."""
    feature: list = field(default_factory=lambda: [0])
    threshold: list = field(default_factory=lambda: [0])
    left: list = field(default_factory=lambda: [-1])
    right: list = field(default_factory=lambda: [-1])
    missing_left: list = field(default_factory=lambda: [False])
    value: list = field(default_factory=lambda: [0.0])
    gain: list = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, threshold: int, missing_left: bool, gain: float, values: tuple[float, float]) -> tuple[int, int]:
        self.feature[node], self.threshold[node], self.missing_left[node], self.gain[node] = feature, threshold, missing_left, gain
        for side, value in zip((self.left, self.right), values, strict=True):
            side[node] = len(self.value)
            for column, default in ((self.feature, 0), (self.threshold, 0), (self.left, -1), (self.right, -1), (self.missing_left, False), (self.gain, 0.0)):
                column.append(default)
            self.value.append(value)
        return self.left[node], self.right[node]

    def packed(self) -> Tree:
        """The same tree in arrays: thousands of them go to the driver."""
        return Tree(*(array(t, c) for t, c in zip("iiiibdd", (self.feature, self.threshold, self.left, self.right, self.missing_left, self.value, self.gain), strict=True)))

    def ends_in(self, pruned: Tree) -> np.ndarray:
        """The node of ``pruned``, a tree that ends earlier, in which the rows of each node end."""
        out, pairs = np.zeros(len(self.value), np.intp), [(0, 0)]
        while pairs:
            old, new = pairs.pop()
            out[old] = new
            if self.left[old] >= 0:
                leaf = pruned.left[new] < 0
                pairs += [(self.left[old], new if leaf else pruned.left[new]), (self.right[old], new if leaf else pruned.right[new])]
        return out

    def best_first(self, leaves: int) -> Tree:
        """The tree that splits the node of the highest gain first, until there are ``leaves`` leaves."""
        out, heap, tick = Tree(value=[self.value[0]]), [(-self.gain[0], 0, 0, 0)] if self.left[0] >= 0 else [], 0
        while heap and len(out.value) < 2 * leaves - 1:
            _, _, old, new = heapq.heappop(heap)
            pair = out.split(new, self.feature[old], self.threshold[old], self.missing_left[old], self.gain[old],
                             (self.value[self.left[old]], self.value[self.right[old]]))
            for child, at in zip((self.left[old], self.right[old]), pair, strict=True):
                if self.left[child] >= 0:
                    tick += 1
                    heapq.heappush(heap, (-self.gain[child], tick, child, at))
        return out

    @property
    def n_leaves(self) -> int:
        return (len(self.value) + 1) // 2

    def arrays(self) -> tuple[np.ndarray, ...]:
        return (*(np.array(x) for x in (self.feature, self.threshold, self.left, self.right)), np.array(self.missing_left, bool), np.array(self.value))


def _nodes(tree: tuple[np.ndarray, ...], x: Mapping[int, np.ndarray] | np.ndarray, n: int, categorical: np.ndarray) -> np.ndarray:
    """The node each of ``n`` rows ends in, step by step; ``x`` has the bins of each feature."""
    feature, threshold, left, right, missing_left, _ = tree
    node = np.zeros(n, np.int32)
    for at in np.flatnonzero(left >= 0).tolist():  # a node comes before its children
        own = np.flatnonzero(node == at)
        v = x[feature[at]][own]
        go = np.where(v == 0, missing_left[at], v == threshold[at] if categorical[feature[at]] else v <= threshold[at])
        node[own] = np.where(go, left[at], right[at])
    return node


#: A power of two times this number has its exponent's own pattern in the top six bits.
_BRUIJN = 0x03F79D71B4CB0A89


class Walk:
    """Where rows end in a tree: for each feature and bin, the set of leaves that its tests leave open; one leaf is in all sets."""

    def __init__(self, tree: Tree, sizes: np.ndarray, categorical: np.ndarray):
        self.features = sorted({j for j, child in zip(tree.feature, tree.left, strict=True) if child >= 0})
        self.whole = (tree.arrays(), categorical) if tree.n_leaves > 64 else None
        if self.whole:
            return
        self.open = {j: np.full(int(sizes[j]) + 1, (1 << tree.n_leaves) - 1, np.uint64) for j in self.features}
        self.ends = np.zeros(64, np.int64)
        under, leaf = [0] * len(tree.value), 0
        for node in reversed(range(len(tree.value))):  # a node comes before its children
            if tree.left[node] < 0:
                under[node] = 1 << leaf
                self.ends[(under[node] * _BRUIJN & (1 << 64) - 1) >> 58] = node
                leaf += 1
                continue
            j, left, right = tree.feature[node], under[tree.left[node]], under[tree.right[node]]
            under[node], v = left | right, np.arange(int(sizes[j]) + 1)
            go = v == tree.threshold[node] if categorical[j] else v <= tree.threshold[node]
            go[0] = tree.missing_left[node]
            self.open[j] &= ~np.where(go, np.uint64(right), np.uint64(left))

    def __call__(self, x: Mapping[int, np.ndarray] | np.ndarray, n: int) -> np.ndarray:
        """The node of each of ``n`` rows; ``x`` has the bins of each feature."""
        if self.whole:
            return _nodes(self.whole[0], x, n, self.whole[1])
        if not self.features:
            return np.zeros(n, np.int64)
        leaves = self.open[self.features[0]][x[self.features[0]]]
        for j in self.features[1:]:
            leaves &= self.open[j][x[j]]
        return self.ends[(leaves * np.uint64(_BRUIJN)) >> np.uint64(58)]


@dataclass
class Binning:
    """Bins of every feature, 0 for a missing value: numeric ones by ascending edges, categories by their place in a sorted list."""
    id_col: str
    numeric: list
    categorical: list
    edges: list                     # of each numeric column; bin i holds values up to edge i - 1
    values: list                    # of each categorical column
    fills: np.ndarray               # fold x feature: the bin of the fold's median or mode, 0 if there is none
    native: bool

    @property
    def is_categorical(self) -> np.ndarray:
        return np.array([False] * len(self.numeric) + [True] * len(self.categorical))

    @property
    def sizes(self) -> np.ndarray:
        return np.array([len(e) + 2 for e in self.edges] + [len(v) + 1 for v in self.values])

    @property
    def dtype(self) -> type:
        return np.uint8 if self.sizes.max(initial=0) < 256 else np.uint16

    def codes(self, batch: pa.RecordBatch) -> np.ndarray:
        """The bins of rows of ``inputs``, a line for each feature."""
        x = np.zeros((len(self.sizes), len(batch)), self.dtype)
        for j, edges in enumerate(self.edges):
            v = batch[f"_n{j}"].to_numpy(zero_copy_only=False)
            x[j] = np.where(np.isnan(v), 0, np.searchsorted(edges, v, "left") + 1)
        for j, known in enumerate(self.values):
            code = pc.index_in(batch[f"_c{j}"], value_set=pa.array(known, pa.string())).fill_null(-1).to_numpy(zero_copy_only=False)
            missing = batch[f"_c{j}"].is_null().to_numpy(zero_copy_only=False)
            x[len(self.numeric) + j] = np.where(missing, 0, np.where(code < 0, len(known) + 1, code + 1))
        return x

    def inputs(self, df: DataFrame, keep: Sequence) -> DataFrame:
        """``keep`` and the columns that ``codes`` reads."""
        def number(c: str):
            x = F.col(c).cast("double")
            x = F.when(~F.isnan(x), x)
            return F.coalesce(x, F.lit(0.0)) if self.native else x

        def text(c: str):
            return F.coalesce(F.col(c).cast("string"), F.lit("Missing")) if self.native else F.col(c).cast("string")

        columns = [number(c).alias(f"_n{j}") for j, c in enumerate(self.numeric)] + [text(c).alias(f"_c{j}") for j, c in enumerate(self.categorical)]
        return df.select(*keep, *columns)


def fit_binning(df: DataFrame, prep: FoldPreprocessModel, id_col: str, k: int, max_bins: int) -> Binning:
    """Edges of all rows' values (no label is read): every distinct value of a column with few of them, else quantiles.

    Two aggregates; categories are those of the folds' vocabularies.
    """
    native = prep.kind == "native"
    raw = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in prep.numeric]
    xs = [F.coalesce(x, F.lit(0.0)) if native else x for x in raw]
    probabilities = [i / max_bins for i in range(1, max_bins)]
    edges: list[np.ndarray] = []
    if xs:
        aggs = [a for j, x in enumerate(xs) for a in (F.approx_count_distinct(x).alias(f"n{j}"), F.percentile_approx(x, probabilities, 10_000).alias(f"q{j}"))]
        row = df.agg(*aggs).first()
        few = [j for j in range(len(xs)) if row[f"n{j}"] <= max_bins]
        sets = df.agg(*[F.collect_set(xs[j]).alias(f"s{j}") for j in few]).first() if few else None
        for j in range(len(xs)):
            values = sorted(sets[f"s{j}"]) if j in few else sorted(set(row[f"q{j}"] or []))
            edges.append(np.array(values[:-1] if j in few else values, float))
    names = prep.categorical
    values = [sorted({str(v) for f in range(k) for v in prep.vocab.categories.get((f, c), [])}) for c in names]
    for c, v in zip(names, values, strict=True):
        if len(v) > 65_000:
            raise ValueError(f"{c} has {len(v)} categories; a bin is two bytes: use a target encoding for this column")
    fills = np.zeros((k, len(prep.numeric) + len(names)), np.int64)
    if not native:
        for f in range(k):
            for j, c in enumerate(prep.numeric):
                median = prep.medians.get((f, c))
                fills[f, j] = 0 if median is None else int(np.searchsorted(edges[j], median, "left")) + 1
            for j, c in enumerate(names):
                mode = prep.modes.get((f, c))
                fills[f, len(prep.numeric) + j] = values[j].index(str(mode)) + 1 if mode is not None and str(mode) in values[j] else 0
    return Binning(id_col, list(prep.numeric), list(names), edges, values, fills, native)


def _uniform(key: np.ndarray, salt: int) -> np.ndarray:
    """A number in (0, 1) of each row key, by a 64-bit finaliser."""
    x = key.view(np.uint64) + np.uint64(salt & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) * 2.0 ** -53 + 2.0 ** -54


def _salt(p: BoostParams, round_: int, fold: int, kind: int) -> int:
    return ((p.seed * 1_000_003 + round_) * 1_009 + fold * 2 + kind) * 0x9E3779B97F4A7C15


@dataclass
class Block:
    """Some rows of the state, those of a fold side by side. ``draw``: the rows that train a fold's model in this round, ``h`` their weights."""
    key: np.ndarray | None
    ends: np.ndarray                # the rows of fold f lie from ends[f] to ends[f + 1]
    y: np.ndarray
    x: np.ndarray                   # a line for each feature
    preds: list
    draw: dict = field(default_factory=dict)
    h: dict = field(default_factory=dict)

    def drawn(self, p: BoostParams, round_: int, folds: Iterable[int]) -> Block:
        """The block with the rows and weights of another round."""
        if p.subsample < 1:
            self.draw = {}
            for f in folds:
                self.draw[f] = _uniform(self.key, _salt(p, round_, f, 0)) < p.subsample
                self.draw[f][self.ends[f]:self.ends[f + 1]] = False
        if p.bagging_temperature > 0:
            self.h = {f: np.rint((-np.log(_uniform(self.key, _salt(p, round_, f, 1)))) ** p.bagging_temperature * 2.0 ** 30) * 2.0 ** -30 for f in folds}
        return self

    def training(self, f: int, column: np.ndarray) -> np.ndarray:
        """Values of the rows that train fold ``f``."""
        return column[self.draw[f]] if self.draw else np.concatenate([column[:self.ends[f]], column[self.ends[f + 1]:]])


def _gathered(base: list, n_features: int, dtype, p: BoostParams, k: int):
    """Blocks of about ``BLOCK_ROWS`` rows out of the small pieces that a part got."""
    def block(pieces: list) -> Block:
        fold = np.concatenate([np.frombuffer(r["fold"], np.int32) for r in pieces])
        order = np.argsort(fold, kind="stable")
        x = np.concatenate([np.frombuffer(r["x"], dtype).reshape(n_features, -1) for r in pieces], 1)
        key = np.concatenate([np.frombuffer(r["key"], np.int64) for r in pieces])[order] if p.subsample < 1 or p.bagging_temperature > 0 else None
        ends = np.searchsorted(fold[order], np.arange(k + 1))
        y = np.concatenate([np.frombuffer(r["label"]) for r in pieces])[order]
        return Block(key, ends, y, x[:, order], [np.full(len(y), b) for b in base]).drawn(p, 0, range(k))

    def run(rows: Iterator) -> Iterator[Block]:
        held: list = []
        for r in rows:
            held.append(r)
            if sum(h["n"] for h in held) >= BLOCK_ROWS:
                yield block(held)
                held = []
        if held:
            yield block(held)
    return run


def _advance(walks: dict[int, tuple], p: BoostParams, round_: int):
    """Blocks with the last round's trees added to the predictions of their folds, drawn for ``round_``."""
    def run(blocks: Iterator[Block]) -> Iterator[Block]:
        for block in blocks:
            for f, (walk, values) in walks.items():
                block.preds[f] = block.preds[f] + p.step * values[walk(block.x, len(block.y))]
            yield block.drawn(p, round_, walks)
    return run


def _bundles(features: list, sizes: np.ndarray) -> list[list[int]]:
    """Features in groups that have at most ``CELLS`` combinations of bins; a larger one is alone."""
    out, cells = [], CELLS
    for j in sorted(features, key=lambda j: (sizes[j], j)):
        cells *= int(sizes[j]) + 1
        if out and cells <= CELLS:
            out[-1].append(j)
        else:
            out.append([j])
            cells = int(sizes[j]) + 1
    return out


def _sums(walks: dict[int, Walk], slots: dict[int, np.ndarray], features: dict[int, list], sizes: np.ndarray, p: BoostParams, k: int, judge: bool):
    """A task's gradient histograms ((0, fold, feature), data) over the nodes to split, and held-out errors ((1, fold, 0), data) if ``judge``.

    Features of few bins are summed together, by their combinations.
    """
    bundles = {f: _bundles(features[f], sizes) for f in walks}
    absolute = p.loss == "absolute"

    def run(blocks: Iterator[Block]) -> Iterator[tuple]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        errors = np.zeros((k, 2))
        for block in blocks:
            if judge:
                for f in range(k):
                    own = slice(block.ends[f], block.ends[f + 1])
                    d = block.preds[f][own] - block.y[own]
                    errors[f] += (np.abs(d) if absolute else d * d).sum(), len(d)
            for f, walk in walks.items():
                n = int(slots[f].max()) + 1
                g = block.training(f, block.preds[f]) - block.training(f, block.y)
                h = block.training(f, block.h[f]) if block.h else None
                xs = {j: block.training(f, block.x[j]) for j in {*walk.features, *features[f]}}
                slot = slots[f][walk(xs, len(g))]
                if len(slots[f]) > n:
                    at = np.flatnonzero(slot >= 0)
                    if len(at) < len(slot):
                        g, slot, h, xs = g[at], slot[at], None if h is None else h[at], {j: xs[j][at] for j in features[f]}
                if absolute:  # sums of the weights by sign hold both gradients and weights
                    sign = (g > 0).astype(np.intp) - (g < 0) + 1
                else:
                    g = np.rint((g if h is None else g * h) * 2.0 ** 30) * 2.0 ** -30
                for i, group in enumerate(bundles[f]):
                    cell = slot
                    for j in group:
                        cell = cell * (int(sizes[j]) + 1) + xs[j]
                    size = n * math.prod(int(sizes[j]) + 1 for j in group)
                    if absolute:
                        part = np.bincount(cell * 3 + sign, weights=h, minlength=3 * size).reshape(size, 3)
                        part = np.stack([part[:, 2] - part[:, 0], part.sum(1)]).astype(float)
                    else:
                        part = np.stack([np.bincount(cell, weights=g, minlength=size), np.bincount(cell, weights=h, minlength=size)])
                    sums[f, i] = sums[f, i] + part if (f, i) in sums else part
        for (f, i), total in sums.items():
            group = bundles[f][i]
            total = total.reshape(2, -1, *(int(sizes[j]) + 1 for j in group))
            for a, j in enumerate(group):
                yield (0, f, j), total.sum(axis=tuple(c + 2 for c in range(len(group)) if c != a)).reshape(2, -1)
        if judge:
            yield from (((1, f, 0), errors[f]) for f in range(k))
    return run


def _weight(g, h, p: BoostParams):
    """Score of a node with gradient sum g and weight h: squared thresholded gradient over weight."""
    g = np.sign(g) * np.maximum(np.abs(g) - p.l1, 0.0)
    return g * g / np.maximum(h + p.l2, 1e-12)


def leaf_value(g: float, h: float, p: BoostParams) -> float:
    return float(-np.sign(g) * max(abs(g) - p.l1, 0.0) / max(h + p.l2, 1e-12))


def _splits(sums: np.ndarray, fill: int, categorical: bool, p: BoostParams):
    """Gain (-inf if not allowed) and left sums of every threshold of every node, and the nodes' sums."""
    g, h = sums.copy()
    if fill:
        for s in (g, h):
            s[:, fill] += s[:, 0]
            s[:, 0] = 0
    gl, hl = (g, h) if categorical else (np.cumsum(g, 1), np.cumsum(h, 1))
    gt, ht = g.sum(1, keepdims=True), h.sum(1, keepdims=True)
    gain = _weight(gl, hl, p) + _weight(gt - gl, ht - hl, p) - _weight(gt, ht, p)
    gain[(hl < p.min_child) | (ht - hl < p.min_child) | (hl <= 0) | (ht - hl <= 0)] = -np.inf
    if categorical and not fill:
        gain[:, 0] = -np.inf  # bin 0 goes with the rest: it has no value to split off
    return gain, gl, hl, gt[:, 0], ht[:, 0]


def _bests(fills: np.ndarray, sizes: np.ndarray, categorical: np.ndarray, p: BoostParams):
    """Sums the histograms that a task got, one after another, and finds the best split of each fold and node among them."""
    def run(parts: Iterator[tuple]) -> Iterator[dict]:
        held: dict[tuple[int, int, int], np.ndarray] = {}
        for key, part in parts:
            held[key] = held[key] + part if key in held else part
        best: dict[tuple[int, int], dict] = {}
        for (kind, f, j), data in sorted(held.items()):
            if kind == 1:
                best[f, -1] = {"fold": f, "feature": -1, "threshold": 0, "gain": 0.0, "slots": [], "gl": data[:1].tolist(), "hl": data[1:].tolist(), "g": [], "h": []}
                continue
            sums = data.reshape(2, -1, int(sizes[j]) + 1)
            gain, gl, hl, g, h = _splits(sums, int(fills[f, j]), bool(categorical[j]), p)
            if p.symmetric:
                total = np.where(np.isfinite(gain), np.maximum(gain, 0), 0).sum(0)
                t = int(total.argmax())
                if (f, 0) not in best or total[t] > best[f, 0]["gain"]:
                    best[f, 0] = {"fold": f, "feature": j, "threshold": t, "gain": float(total[t]), "slots": list(range(len(g))),
                                  "gl": gl[:, t].tolist(), "hl": hl[:, t].tolist(), "g": g.tolist(), "h": h.tolist()}
                continue
            at = gain.argmax(1)
            for s, t in enumerate(at.tolist()):
                if (f, s) not in best or gain[s, t] > best[f, s]["gain"]:
                    best[f, s] = {"fold": f, "feature": j, "threshold": t, "gain": float(gain[s, t]), "slots": [s],
                                  "gl": [float(gl[s, t])], "hl": [float(hl[s, t])], "g": [float(g[s])], "h": [float(h[s])]}
        yield from best.values()
    return run


@dataclass
class BoostedFolds:
    """The ensemble of each fold, cut to its best prefix; ``errors[f][r]`` is the held-out error after r rounds."""
    binning: Binning
    base: list
    trees: dict                     # fold -> [Tree]
    errors: dict
    params: BoostParams
    label: str = "label"
    fold_col: str = "fold"

    def rounds(self, fold: int) -> int:
        return len(self.trees[fold])

    def attach(self, df: DataFrame, out_col: str, own_fold: bool) -> DataFrame:
        """``df`` with a prediction: by the model that didn't see the row's fold, or the mean of all models; one pass, no shuffle."""
        share_library(df.sparkSession)
        schema = df.select("*").schema.add(out_col, "double")
        shared = df.sparkSession.sparkContext.broadcast(self._walks())
        binning, base, step, fold_col, keep = self.binning, self.base, self.params.step, self.fold_col, df.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not len(batch):
                    continue
                x = binning.codes(batch)
                fold = batch[fold_col].to_numpy(zero_copy_only=False) if own_fold else None
                preds = np.zeros(len(batch))
                for f, walks in shared.value.items():
                    at = np.flatnonzero(fold == f) if own_fold else np.arange(len(batch))
                    if len(at):
                        xs, total = x[:, at], np.full(len(at), base[f])
                        for walk, values in walks:
                            total += step * values[walk(xs, len(at))]
                        preds[at] += total if own_fold else total / len(shared.value)
                yield pa.RecordBatch.from_arrays([batch[c] for c in keep] + [pa.array(preds)], [*keep, out_col])
        return binning.inputs(df, keep).mapInArrow(run, schema)

    def _walks(self) -> dict[int, list]:
        return {f: [_walk(t, self.binning) for t in trees] for f, trees in self.trees.items()}

    def staged_errors(self, train: DataFrame) -> DataFrame:
        """(fold, rounds, error): the held-out error of every prefix of every ensemble, in one pass."""
        share_library(train.sparkSession)
        shared = train.sparkSession.sparkContext.broadcast(self._walks())
        binning, base, p, fold_col, label = self.binning, self.base, self.params, self.fold_col, self.label

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = {f: np.zeros((len(t) + 1, 2)) for f, t in shared.value.items()}
            for batch in batches:
                if not len(batch):
                    continue
                x = binning.codes(batch)
                fold, y = (batch[c].to_numpy(zero_copy_only=False) for c in (fold_col, label))
                for f, trees in shared.value.items():
                    at = np.flatnonzero(fold == f)
                    xs, d = x[:, at], base[f] - y[at]
                    for r in range(len(trees) + 1):
                        if r:
                            walk, values = trees[r - 1]
                            d = d + p.step * values[walk(xs, len(at))]
                        out[f][r] += (np.abs(d).sum() if p.loss == "absolute" else (d * d).sum()), len(at)
            rows = [(f, r, *v) for f, e in out.items() for r, v in enumerate(e.tolist())]
            yield pa.RecordBatch.from_pydict({c: [r[i] for r in rows] for i, c in enumerate(("fold", "rounds", "s", "n"))},
                                             pa.schema([("fold", pa.int32()), ("rounds", pa.int32()), ("s", pa.float64()), ("n", pa.float64())]))
        rows = binning.inputs(train, list(dict.fromkeys([fold_col, label]))).mapInArrow(run, "fold int, rounds int, s double, n double")
        sums = rows.groupBy("fold", "rounds").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).where("n > 0")
        return sums.select("fold", "rounds", (F.col("s") / F.col("n")).alias("error"))


def fit_boosted(train: DataFrame, prep: FoldPreprocessModel, p: BoostParams, id_col: str, label: str = "label", fold_col: str = "fold", k: int = 5) -> BoostedFolds:
    """The ``k`` ensembles of out-of-fold boosting; ``prep`` (kind tree or native) holds the folds' imputation statistics.

    Rows without a label take no part. A fold without training rows predicts 0.
    """
    rows = train.where(F.col(label).isNotNull() & F.col(fold_col).isNotNull())
    binning = fit_binning(rows, prep, id_col, k, p.max_bins)
    categorical, sizes = binning.is_categorical, binning.sizes
    base = _base(rows, label, fold_col, k, p.loss)
    model = BoostedFolds(binning, base, {f: [] for f in range(k)}, {f: [] for f in range(k)}, p, label, fold_col)
    binned, n = _pieces(rows, binning, id_col, label, fold_col)
    if n and len(sizes) and n * (len(sizes) * np.dtype(binning.dtype).itemsize + ROW_BYTES) <= ALONE_BYTES:
        for f, trees, errors in _each_alone(binned, n, binning, base, p, k):
            model.trees[f], model.errors[f] = trees, errors
        return model
    state, parts = _dealt(binned, n, binning, base, p, k)
    width = len(sizes)
    active, rng, old = set(range(k)) if len(sizes) else set(), np.random.default_rng(p.seed), None
    sampled = p.subsample < 1 or p.colsample < 1 or p.bagging_temperature > 0
    for round_ in range(p.rounds + 1):
        if not active:
            break
        last = round_ == p.rounds
        trees = {f: Tree() for f in sorted(active)}
        chosen = {f: sorted(rng.choice(len(sizes), max(1, round(p.colsample * len(sizes))), replace=False).tolist()) if len(sizes) else [] for f in range(k)}
        frontier = {f: [0] for f in trees}
        for depth in range(p.depth):
            growing = {f: nodes for f, nodes in frontier.items() if nodes}
            if not growing:
                break
            slots = {}
            for f, nodes in growing.items():
                slots[f] = np.full(len(trees[f].value), -1)
                slots[f][nodes] = np.arange(len(nodes))
            walks = {f: Walk(trees[f], sizes, categorical) for f in growing} if not last else {}
            sums = state.mapPartitions(_sums(walks, slots, chosen, sizes, p, k, depth == 0))
            if parts > 1:  # else the one task has the whole sums already
                sums = sums.partitionBy(min(parts, k * len(sizes)), lambda key: key[1] * width + key[2])
            found = sums.mapPartitions(_bests(binning.fills, sizes, categorical, p)).collect()
            if depth == 0:
                for r in found:
                    if r["feature"] < 0 and r["fold"] in active and r["hl"][0]:
                        model.errors[r["fold"]].append(r["gl"][0] / r["hl"][0])
                for f in list(active):
                    e = model.errors[f]
                    if p.patience is not None and e and len(e) - 1 - int(np.argmin(e)) >= p.patience:
                        active.discard(f)
                trees = {f: t for f, t in trees.items() if f in active}
                if old is not None:  # the state that this one was made from
                    old.unpersist()
                    old = None
                if last or not active:
                    break
            frontier = _grown(trees, {f: n for f, n in growing.items() if f in active}, found, binning, p)
        if last or not active:
            break
        if p.leaves:
            trees = {f: t.best_first(p.leaves) for f, t in trees.items()}
        for f, t in trees.items():
            model.trees[f].append(t)
            if t.left[0] < 0 and not sampled:  # nothing to split, in no later round either
                active.discard(f)
        old, state = state, state.mapPartitions(_advance({f: _walk(t, binning) for f, t in trees.items()}, p, round_ + 1)).persist(StorageLevel.MEMORY_AND_DISK)
        if (round_ + 1) % CUT == 0:
            state.checkpoint()
    state.unpersist()
    for f, e in model.errors.items():
        if p.patience is not None and e:
            model.trees[f] = model.trees[f][:int(np.argmin(e))]
    return model


def _walk(tree: Tree, binning: Binning) -> tuple[Walk, np.ndarray]:
    """Where rows end in a tree, and its nodes' values."""
    return Walk(tree, binning.sizes, binning.is_categorical), np.array(tree.value)


def _pieces(rows: DataFrame, binning: Binning, id_col: str, label: str, fold_col: str) -> tuple[DataFrame, int]:
    """The binned rows in pieces of ``PIECE_ROWS``, written once, and their number."""
    share_library(rows.sparkSession)
    ensure_checkpoint_dir(rows.sparkSession)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), PIECE_ROWS):
                own = batch.slice(a, PIECE_ROWS)
                key, fold, y = (own[c].to_numpy(zero_copy_only=False).tobytes() for c in ("_key", "_fold", "_label"))
                yield pa.RecordBatch.from_pydict({"n": [len(own)], "key": [key], "fold": [fold], "label": [y], "x": [binning.codes(own).tobytes()]},
                                                 pa.schema([("n", pa.int32()), *((c, pa.binary()) for c in ("key", "fold", "label", "x"))]))

    keep = [F.xxhash64(F.col(id_col).cast("string")).alias("_key"), F.col(fold_col).cast("int").alias("_fold"), F.col(label).cast("double").alias("_label")]
    binned = stored(binning.inputs(rows, keep).mapInArrow(pieces, "n int, key binary, fold binary, label binary, x binary"))
    return binned, binned.agg(F.sum("n")).first()[0] or 0


def _dealt(binned: DataFrame, n: int, binning: Binning, base: list, p: BoostParams, k: int) -> tuple[RDD, int]:
    """The state in blocks, in as many even parts as keep all cores busy with ``LEAST_ROWS`` rows or more, and at most ``MOST_ROWS``."""
    cores = binned.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(cores, n // LEAST_ROWS))
    if n > parts * MOST_ROWS:
        parts = -(-n // (MOST_ROWS * parts)) * parts
    return binned.repartition(parts).rdd.mapPartitions(_gathered(base, len(binning.sizes), binning.dtype, p, k)).persist(StorageLevel.MEMORY_AND_DISK), parts


#: Bytes of a row in a task that has all of them, besides its bins: label, key, prediction, gradient, weight, node and places.
ROW_BYTES = 72


class Alone:
    """All rows in one task, for the whole ensemble of one fold: the fold's own rows behind those that train it.

    Each row keeps its node, so that a level moves the rows on by one test. Of two
    children the one with fewer rows is summed, the other is what the parent has left.
    """

    def __init__(self, f: int, pieces: Iterable, n: int, base: list, binning: Binning, p: BoostParams, k: int):
        self.f, self.binning, self.p, self.k = f, binning, p, k
        self.sizes, self.categorical = binning.sizes, binning.is_categorical
        self.key, self.y, own, at = np.empty(n, np.int64), np.empty(n), np.empty(n, bool), 0
        self.x = np.empty((len(self.sizes), n), binning.dtype)
        for r in pieces:
            to = slice(at, at + r["n"])
            self.key[to], self.y[to], own[to] = np.frombuffer(r["key"], np.int64), np.frombuffer(r["label"]), np.frombuffer(r["fold"], np.int32) == f
            self.x[:, to] = np.frombuffer(r["x"], binning.dtype).reshape(len(self.sizes), -1)
            at = to.stop
        order = np.lexsort((self.key, own))
        self.key, self.y, self.m = self.key[order], self.y[order], n - int(own.sum())
        for line in self.x:
            line[:] = line[order]
        self.pred, self.node = np.full(n, base[f]), np.zeros(n, np.intp)
        self.bests = _bests(binning.fills, self.sizes, self.categorical, p)

    def fit(self) -> tuple[list, list]:
        """Trees of the best prefix and the held-out error of each prefix, as ``fit_boosted`` finds them."""
        p, m, trees, errors, rng = self.p, self.m, [], [], np.random.default_rng(self.p.seed)
        sampled = p.subsample < 1 or p.colsample < 1 or p.bagging_temperature > 0
        for round_ in range(p.rounds + 1):
            take = max(1, round(p.colsample * len(self.sizes)))
            chosen = [sorted(rng.choice(len(self.sizes), take, replace=False).tolist()) for _ in range(self.k)][self.f]
            if m < len(self.y):
                d = self.pred[m:] - self.y[m:]
                errors.append(float((np.abs(d) if p.loss == "absolute" else d * d).sum() / len(d)))
                if p.patience is not None and len(errors) - 1 - int(np.argmin(errors)) >= p.patience:
                    break
            if round_ == p.rounds:
                break
            tree = self.tree(round_, chosen)
            trees.append(tree.packed())
            if tree.left[0] < 0 and not sampled:  # nothing to split, in no later round either
                break
        return trees[:int(np.argmin(errors))] if p.patience is not None and errors else trees, errors

    def tree(self, round_: int, chosen: list) -> Tree:
        """Grows the round's tree and adds it to the predictions."""
        p, m, tree, frontier = self.p, self.m, Tree(), [0]
        rows = np.flatnonzero(_uniform(self.key[:m], _salt(p, round_, self.f, 0)) < p.subsample) if p.subsample < 1 else None
        of = (lambda v: v[:m]) if rows is None else (lambda v: v[rows])
        h = np.rint((-np.log(_uniform(of(self.key), _salt(p, round_, self.f, 1)))) ** p.bagging_temperature * 2.0 ** 30) * 2.0 ** -30 if p.bagging_temperature > 0 else None
        g = of(self.pred) - of(self.y)
        if p.loss == "absolute":  # sums of the weights by sign hold both gradients and weights
            g = (g > 0).astype(np.int8) - (g < 0) + 1
            exact = h is None or h.sum() < 2.0 ** 22
        else:
            g = np.rint((g if h is None else g * h) * 2.0 ** 30) * 2.0 ** -30
            exact = np.abs(g).sum() < 2.0 ** 22 and (h is None or h.sum() < 2.0 ** 22)
        self.node[:] = 0
        bundles = _bundles(chosen, self.sizes)
        sums = self.sums(bundles, rows, None, np.zeros(len(g), np.intp), 1, g, h)
        for depth in range(p.depth):
            found = list(self.bests(((0, self.f, j), sums[j].reshape(2, -1)) for j in chosen))
            after = _grown({self.f: tree}, {self.f: frontier}, found, self.binning, p)[self.f]
            if not after:
                break
            self.move(tree, [node for node in frontier if tree.left[node] >= 0])
            if depth + 1 == p.depth:
                break
            node, slots = of(self.node), np.full(len(tree.value), -1)
            if exact:
                count = np.bincount(node, minlength=len(tree.value))[after].reshape(-1, 2)
                side = (count[:, 1] < count[:, 0]).astype(np.intp)
                pairs = np.arange(len(side))
                slots[np.array(after).reshape(-1, 2)[pairs, side]] = pairs
            else:
                slots[after] = np.arange(len(after))
            slot = slots[node]
            at = np.flatnonzero(slot >= 0)
            parts = self.sums(bundles, rows, at, slot[at], int(slots.max()) + 1, g, h)
            if exact:
                split = [s for s, node in enumerate(frontier) if tree.left[node] >= 0]
                for j, part in parts.items():
                    whole = np.empty((2, len(after), part.shape[2]))
                    whole[:, 2 * pairs + side], whole[:, 2 * pairs + 1 - side] = part, sums[j][:, split] - part
                    parts[j] = whole
            sums, frontier = parts, after
        if p.leaves and tree.n_leaves > p.leaves:
            tree, old = tree.best_first(p.leaves), tree
            self.node = old.ends_in(tree)[self.node]
        self.pred += (p.step * np.array(tree.value))[self.node]
        return tree

    def sums(self, bundles: list, rows: np.ndarray | None, at: np.ndarray | None, slot: np.ndarray, n: int, g: np.ndarray, h: np.ndarray | None) -> dict:
        """Histograms (gradients and weights, slot, bin) of the features in ``bundles`` over the places ``at`` of the round's rows."""
        totals: list = [0.0] * len(bundles)
        for a in range(0, len(slot), CHUNK_ROWS):
            s = slot[a:a + CHUNK_ROWS]
            own = slice(a, a + len(s)) if at is None else at[a:a + len(s)]
            row, gs, hs = own if rows is None else rows[own], g[own], None if h is None else h[own]
            for i, group in enumerate(bundles):
                cell = s
                for j in group:
                    cell = cell * (int(self.sizes[j]) + 1) + self.x[j][row]
                size = n * math.prod(int(self.sizes[j]) + 1 for j in group)
                if self.p.loss == "absolute":
                    part = np.bincount(cell * 3 + gs, weights=hs, minlength=3 * size).reshape(size, 3)
                    part = np.stack([part[:, 2] - part[:, 0], part.sum(1)]).astype(float)
                else:
                    part = np.stack([np.bincount(cell, weights=gs, minlength=size), np.bincount(cell, weights=hs, minlength=size)])
                totals[i] = totals[i] + part
        out = {}
        for total, group in zip(totals, bundles, strict=True):
            shape = (2, n, *(int(self.sizes[j]) + 1 for j in group))
            total = np.zeros(shape) if isinstance(total, float) else total.reshape(shape)
            for a, j in enumerate(group):
                out[j] = total.sum(axis=tuple(c + 2 for c in range(len(group)) if c != a))
        return out

    def move(self, tree: Tree, split: list) -> None:
        """Rows of the nodes ``split`` go to a child of theirs, whether they train or not."""
        features, bins = [tree.feature[node] for node in split], int(self.sizes.max()) + 1
        to = np.repeat(np.arange(len(tree.value))[:, None], bins, 1)
        test = np.zeros(len(tree.value), np.intp)
        for node, j in zip(split, features, strict=True):
            v = np.arange(bins)
            go = v == tree.threshold[node] if self.categorical[j] else v <= tree.threshold[node]
            go[0] = tree.missing_left[node]
            to[node], test[node] = np.where(go, tree.left[node], tree.right[node]), j
        to, one = to.ravel(), features[0] if len(set(features)) == 1 else None
        for a in range(0, len(self.node), CHUNK_ROWS):
            node = self.node[a:a + CHUNK_ROWS]
            v = self.x[one, a:a + len(node)] if one is not None else self.x[test[node], np.arange(a, a + len(node))]
            self.node[a:a + len(node)] = to[node * bins + v]


def _each_alone(binned: DataFrame, n: int, binning: Binning, base: list, p: BoostParams, k: int) -> Iterator[tuple]:
    """(fold, trees, errors) of every fold, from a task that has all rows."""
    def run(f: int, rows: Iterator) -> Iterator[tuple]:
        yield f, *Alone(f, (r for _, r in rows), n, base, binning, p, k).fit()

    dealt = binned.rdd.flatMap(lambda r: [(f, r) for f in range(k)]).partitionBy(k, lambda f: f)
    yield from dealt.mapPartitionsWithIndex(run).collect()


def _grown(trees: dict, growing: dict, found: list, binning: Binning, p: BoostParams) -> dict:
    """Splits the nodes of this level; returns the new ones of each fold."""
    best: dict[tuple[int, int], dict] = {}
    for r in sorted((r for r in found if r["feature"] >= 0), key=lambda r: (-r["gain"], r["feature"])):
        for i, s in enumerate(r["slots"]):
            best.setdefault((r["fold"], s), {"r": r, "i": i})
    after = {}
    for f, nodes in growing.items():
        after[f] = []
        for s, node in enumerate(nodes):
            if (f, s) not in best:
                continue
            r, i = best[f, s]["r"], best[f, s]["i"]
            j, t = r["feature"], r["threshold"]
            gl, hl, g, h = (r[c][i] for c in ("gl", "hl", "g", "h"))
            if not node:
                trees[f].value[0] = leaf_value(g, h, p)
            if not r["gain"] > p.min_gain or not np.isfinite(r["gain"]):
                continue
            fill = int(binning.fills[f, j])
            goes_left = (fill == t if binning.is_categorical[j] else fill <= t) if fill else (t >= 0 and not binning.is_categorical[j])
            after[f] += trees[f].split(node, j, t, goes_left, r["gain"], (leaf_value(gl, hl, p), leaf_value(g - gl, h - hl, p)))
    return after


def _base(rows: DataFrame, label: str, fold_col: str, k: int, loss: str) -> list:
    """Where each fold's ensemble starts: mean of its training labels, or their median under absolute loss."""
    if loss == "absolute":
        med = fold_medians(rows, [label], fold_col, k)
        return [float(med.get((f, label)) or 0.0) for f in range(k)]
    per = {r["f"]: r for r in rows.groupBy(F.col(fold_col).alias("f")).agg(F.count(label).alias("n"), F.sum(label).alias("s")).collect()}
    out = []
    for f in range(k):
        n, s = sum(r["n"] for g, r in per.items() if g != f), sum(r["s"] for g, r in sorted(per.items()) if g != f)
        out.append(float(s / n) if n else 0.0)
    return out


def with_overrides(p: BoostParams, params: dict) -> BoostParams:
    """``p`` with the settings of ``params`` that it knows (maxIter, stepSize and maxDepth are rounds, step and depth)."""
    names = {"maxIter": "rounds", "stepSize": "step", "maxDepth": "depth", "maxBins": "max_bins"}
    return replace(p, **{names.get(key, key): v for key, v in params.items() if hasattr(p, names.get(key, key))})
