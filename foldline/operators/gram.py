"""Linear models of all folds from one pass, on designs with one-hot categories of any width that a driver can solve.

A row's raw vector is, for each numeric column, its value and whether it is
missing, and for each category one indicator a value and one for missing. Sums
of its products by fold don't depend on how a held-out fold imputes, scales or
knows the categories: those are linear maps of the raw vector. So one pass gives
the raw sums of each fold, the sums of the other folds are added, and each fold's
design is a matrix product of them.

Indicators are never laid out: products of two categories are counts of pairs of
codes, those with numbers are sums by code. Tasks add up their rows; blocks of the
sums are added by one task each. The driver gets k matrices of the design's size,
whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldline.operators.linear import FoldStats, Stats, elastic_net_fit, ridge_fit
from foldline.operators.preprocess import FoldPreprocessModel
from foldline.session import share_library

#: Rows of a block of the sums.
BLOCK = 256


@dataclass
class RawDesign:
    """Layout of the raw vector: p values (less ``shift``), p missing flags, then a code for each value of each category and for missing."""
    numeric: list
    categorical: list
    values: list
    shift: np.ndarray

    @property
    def starts(self) -> list[int]:
        """The first place of each category's codes, and the vector's size."""
        out = [2 * len(self.numeric)]
        for v in self.values:
            out.append(out[-1] + len(v) + 1)
        return out

    def columns(self) -> list:
        number = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(f"_n{j}") for j, c in enumerate(self.numeric)]
        return number + [F.col(c).cast("string").alias(f"_c{j}") for j, c in enumerate(self.categorical)]

    def read(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Values (0 where missing), missing flags, and codes (past the last one for a value that isn't listed)."""
        raw = np.stack([batch[f"_n{j}"].to_numpy(zero_copy_only=False).astype(float) for j in range(len(self.numeric))], 1) if self.numeric else np.zeros((len(batch), 0))
        missing = np.isnan(raw)
        codes = []
        for j, known in enumerate(self.values):
            column = batch[f"_c{j}"]
            at = pc.index_in(column, value_set=pa.array(known, pa.string())).fill_null(len(known) + 1).to_numpy(zero_copy_only=False).astype(np.int64)
            codes.append(np.where(column.is_null().to_numpy(zero_copy_only=False), len(known), at))
        return np.where(missing, 0.0, raw - self.shift), missing.astype(float), codes


def _sums(design: RawDesign, k: int):
    """A task's sums of products by fold: the raw vector, 1 and the label with each other, cut into blocks of rows."""
    starts = design.starts
    size = starts[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            fold, y = batch["_fold"].to_numpy(), batch["_y"].to_numpy()
            values, missing, codes = design.read(batch)
            for f in np.unique(fold).tolist():
                at = np.flatnonzero(fold == f)
                dense = np.concatenate([values[at], missing[at], np.ones((len(at), 1)), y[at, None]], 1)
                place = np.append(np.arange(2 * len(design.numeric)), [size, size + 1])
                g = total.setdefault(f, np.zeros((size + 2, size + 2)))
                g[np.ix_(place, place)] += dense.T @ dense
                for i, a in enumerate(codes):
                    own, width = a[at], starts[i + 1] - starts[i]
                    for c, p in enumerate(place.tolist()):
                        part = np.bincount(own, weights=dense[:, c], minlength=width)
                        g[starts[i]:starts[i + 1], p] += part
                        g[p, starts[i]:starts[i + 1]] += part
                    for j, b in enumerate(codes[:i + 1]):
                        other = starts[j + 1] - starts[j]
                        part = np.bincount(own * other + b[at], minlength=width * other).reshape(width, other)
                        g[starts[i]:starts[i + 1], starts[j]:starts[j + 1]] += part
                        if i != j:
                            g[starts[j]:starts[j + 1], starts[i]:starts[i + 1]] += part.T
        for f, g in total.items():
            for b in range(0, size + 2, BLOCK):
                yield pa.RecordBatch.from_pydict({"fold": [f], "block": [b], "data": [g[b:b + BLOCK].tobytes()]},
                                                 pa.schema([("fold", pa.int32()), ("block", pa.int32()), ("data", pa.binary())]))
    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of equal blocks, which lie in one partition."""
    held: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for f, b, data in zip(*(batch[c].to_pylist() for c in ("fold", "block", "data")), strict=True):
            part = np.frombuffer(data)
            held[f, b] = held[f, b] + part if (f, b) in held else part
    for (f, b), g in held.items():
        yield pa.RecordBatch.from_pydict({"fold": [f], "block": [b], "data": [g.tobytes()]}, pa.schema([("fold", pa.int32()), ("block", pa.int32()), ("data", pa.binary())]))


@dataclass
class GramFolds:
    """A linear model of each fold, as weights on the raw vector."""
    design: RawDesign
    models: dict                    # fold -> (intercept, weights)
    fits: dict                      # fold -> (design column names, LinearFit)
    fold_col: str

    def attach(self, df: DataFrame, out_col: str, own_fold: bool) -> DataFrame:
        """``df`` with a prediction: by the model that didn't see the row's fold, or the mean of all models; one pass, no shuffle."""
        share_library(df.sparkSession)
        schema = df.select("*").schema.add(out_col, "double")
        keep, fold_col, design, models = df.columns, self.fold_col, self.design, self.models
        starts = design.starts

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values, missing, codes = design.read(batch)
                fold = batch[fold_col].to_numpy(zero_copy_only=False) if own_fold else None
                preds, p = np.full(len(batch), np.nan) if own_fold else np.zeros(len(batch)), len(design.numeric)
                for f, (intercept, w) in models.items():
                    total = intercept + values @ w[:p] + missing @ w[p:2 * p]
                    for i, code in enumerate(codes):
                        total += np.append(w[starts[i]:starts[i + 1]], 0.0)[code]
                    preds = np.where(fold == f, total, preds) if own_fold else preds + total / len(models)
                yield pa.RecordBatch.from_arrays([batch[c] for c in keep] + [pa.array(preds, from_pandas=True)], [*keep, out_col])
        return df.select(*keep, *design.columns()).mapInArrow(run, schema)


def raw_design(prep: FoldPreprocessModel, k: int) -> RawDesign:
    """The layout for the columns of ``prep``; categories are those of any fold's vocabulary."""
    values = [sorted({str(v) for f in range(k) for v in prep.vocab.categories.get((f, c), [])}) for c in prep.categorical]
    shift = np.array([next((prep.medians[f, c] for f in range(k) if prep.medians.get((f, c)) is not None), 0.0) for c in prep.numeric])
    return RawDesign(list(prep.numeric), list(prep.categorical), values, shift)


def fold_sums(train: DataFrame, design: RawDesign, label: str, fold_col: str, k: int) -> dict[int, np.ndarray]:
    """The raw sums of each fold; rows without a label or fold take no part."""
    share_library(train.sparkSession)
    rows = train.where(F.col(label).isNotNull() & F.col(fold_col).isNotNull()).select(F.col(fold_col).cast("int").alias("_fold"), F.col(label).cast("double").alias("_y"), *design.columns())
    schema = "fold int, block int, data binary"
    found = rows.mapInArrow(_sums(design, k), schema).repartition("fold", "block").mapInArrow(_added, schema).collect()
    size = design.starts[-1] + 2
    out = {f: np.zeros((size, size)) for f in {r["fold"] for r in found}}
    for r in found:
        out[r["fold"]][r["block"]:r["block"] + BLOCK] = np.frombuffer(r["data"]).reshape(-1, size)
    return out


def fold_design(prep: FoldPreprocessModel, design: RawDesign, fold: int) -> tuple[list[str], np.ndarray]:
    """Names of a fold's design columns, and the matrix that makes them of the raw vector (constants aside)."""
    names, columns, p, starts = [], [], len(design.numeric), design.starts
    for j, c in enumerate(design.numeric):
        if prep.medians.get((fold, c)) is not None:
            v = np.zeros(starts[-1])
            scale = prep.moments.get((fold, c), (0.0, 1.0))[1] if prep.kind == "linear" else 1.0
            v[j], v[p + j] = 1 / scale, (prep.medians[fold, c] - design.shift[j]) / scale
            names.append(f"num__{c}")
            columns.append(v)
    for i, c in enumerate(design.categorical):
        place = {x: starts[i] + n for n, x in enumerate(design.values[i])}
        for value in prep.vocab.categories.get((fold, c), []):
            v = np.zeros(starts[-1])
            v[place[str(value)]] = 1.0
            if prep.modes.get((fold, c)) == value:
                v[starts[i + 1] - 1] = 1.0
            names.append(f"cat__{c}__{value}")
            columns.append(v)
    return names, np.stack(columns, 1) if columns else np.zeros((starts[-1], 0))


def training_stats(sums: dict, fold: int, a: np.ndarray) -> Stats:
    """Centred statistics of a fold's design over the rows of the other folds."""
    total = sum((g for f, g in sorted(sums.items()) if f != fold), np.zeros((a.shape[0] + 2,) * 2))
    raw, ones, y = total[:-2, :-2], total[:-2, -2], total[:-2, -1]
    n = total[-2, -2]
    if not n:
        return Stats(0.0, np.zeros(a.shape[1]), 0.0, np.zeros((a.shape[1],) * 2), np.zeros(a.shape[1]), 0.0)
    mx, my = a.T @ ones / n, total[-2, -1] / n
    return Stats(float(n), mx, float(my), a.T @ raw @ a - n * np.outer(mx, mx), a.T @ y - n * mx * my, float(total[-1, -1] - n * my * my))


def fit_gram(train: DataFrame, prep: FoldPreprocessModel, alpha: float, l1_ratio: float | None, label: str = "label", fold_col: str = "fold", k: int = 5) -> GramFolds:
    """A linear model of each held-out fold: ridge (``l1_ratio`` None, penalty alpha * |w|^2) or elastic net, over the design of ``prep``.

    Coordinate descent on wide, collinear designs ends at a relative change of
    1e-5, or exactly where the support's equations can be solved. A fold without
    training rows predicts 0.
    """
    design = raw_design(prep, k)
    sums = fold_sums(train, design, label, fold_col, k)
    models, fits = {}, {}
    for f in range(k):
        names, a = fold_design(prep, design, f)
        st = training_stats(sums, f, a) if sums else training_stats({}, f, a)
        fs = FoldStats(names, {0: st})
        if st.n:
            fit = ridge_fit(fs, st, alpha) if l1_ratio is None else elastic_net_fit(fs, st, alpha, l1_ratio, max_iter=10_000, tol=1e-5)
            models[f], fits[f] = (fit.intercept, a @ fit.coef), (names, fit)
        else:
            models[f] = (0.0, np.zeros(a.shape[0]))
    return GramFolds(design, models, fits, fold_col)


def coefficients(model: GramFolds, spark) -> DataFrame:
    """(fold, feature, coef) of every fold's design column."""
    rows = [(f, name, float(w)) for f, (names, fit) in sorted(model.fits.items()) for name, w in zip(names, fit.coef, strict=True)]
    return spark.createDataFrame(rows, "fold int, feature string, coef double")

