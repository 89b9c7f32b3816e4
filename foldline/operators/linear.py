"""Linear models from per-fold sufficient statistics.

One aggregation pass computes, per fold, the count, the means and the
centred cross products (Spark's stable ``avg`` / ``covar_pop``). The
training statistics of held-out fold ``i`` merge the other folds with the
exact pairwise update, so all ``k`` fits cost one pass over the data; the
``d x d`` solves run on the driver (the collected table is ``k x O(d^2)``
numbers, independent of the row count). Predictions are plain Column
expressions.

Objectives (as the reference models):
* ridge:  ``||y - Xw - b||^2 + alpha ||w||^2``
* elastic net: ``1/(2n) ||y - Xw - b||^2 + alpha l1 ||w||_1 + alpha (1-l1)/2 ||w||^2``
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Stats:
    """Count, means and centred cross products of one group of rows."""
    n: float
    mx: np.ndarray      # d
    my: float
    cxx: np.ndarray     # d x d, sum (x - mx)(x - mx)^T
    cxy: np.ndarray     # d,     sum (x - mx)(y - my)
    cyy: float

    def __add__(self, o: "Stats") -> "Stats":
        """Pairwise (Chan) merge of two groups; exact, no cancellation."""
        n = self.n + o.n
        if n == 0:
            return self
        dx, dy = o.mx - self.mx, o.my - self.my
        f = self.n * o.n / n
        return Stats(n, self.mx + dx * (o.n / n), self.my + dy * (o.n / n),
                     self.cxx + o.cxx + f * np.outer(dx, dx), self.cxy + o.cxy + f * dx * dy,
                     self.cyy + o.cyy + f * dy * dy)

    def centred(self):
        return self.mx, self.my, self.cxx, self.cxy


@dataclass
class FoldStats:
    features: list
    per_fold: dict      # fold -> Stats

    def merged(self, folds) -> Stats:
        it = iter(self.per_fold[f] for f in folds)
        acc = next(it)
        for s in it:
            acc = acc + s
        return acc

    @property
    def total(self) -> Stats:
        return self.merged(sorted(self.per_fold))

    def train(self, fold) -> Stats:
        """Statistics of the rows outside ``fold`` (all folds but one, merged)."""
        others = [f for f in sorted(self.per_fold) if f != fold]
        return self.merged(others) if others else self.total


def fold_stats(df: DataFrame, features: Sequence[str], label: str,
               fold_col: str | None = "fold") -> FoldStats:
    """Sufficient statistics per fold in one pass (``fold_col=None``: one
    group, fold 0): counts, means and centred cross products from Spark's
    single-pass, numerically stable ``avg`` / ``covar_pop`` aggregates.

    Rows with a NULL feature or label are skipped; callers impute first.
    """
    feats = list(features)
    d = len(feats)
    valid = F.col(label).isNotNull()
    for c in feats:
        valid = valid & F.col(c).isNotNull()
    data = df.where(valid)
    xs = [F.col(c).cast("double") for c in feats]
    y = F.col(label).cast("double")
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(y).alias("my"), F.covar_pop(y, y).alias("vyy")]
    aggs += [F.avg(x).alias(f"mx{i}") for i, x in enumerate(xs)]
    aggs += [F.covar_pop(x, y).alias(f"cxy{i}") for i, x in enumerate(xs)]
    aggs += [F.covar_pop(xs[i], xs[j]).alias(f"cxx{i}_{j}") for i in range(d) for j in range(i, d)]
    grouped = data.groupBy(fold_col).agg(*aggs) if fold_col else data.agg(*aggs)
    per = {}
    for r in grouped.collect():
        key = r[fold_col] if fold_col else 0
        n = float(r["n"])
        cxx = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                cxx[i, j] = cxx[j, i] = (r[f"cxx{i}_{j}"] or 0.0) * n
        per[key] = Stats(n, np.array([r[f"mx{i}"] for i in range(d)], dtype=float), float(r["my"]),
                         cxx, np.array([(r[f"cxy{i}"] or 0.0) * n for i in range(d)], dtype=float),
                         float(r["vyy"] or 0.0) * n)
    return FoldStats(feats, per)


@dataclass
class LinearFit:
    coef: np.ndarray
    intercept: float

    def predict(self, features: Sequence[str]) -> Column:
        out = F.lit(float(self.intercept))
        for w, c in zip(self.coef, features):
            out = out + F.lit(float(w)) * F.col(c)
        return out


def ridge_fit(fs: FoldStats, st: Stats, alpha: float) -> LinearFit:
    mx, my, cxx, cxy = st.centred()
    w = np.linalg.solve(cxx + alpha * np.eye(len(mx)), cxy)
    return LinearFit(w, float(my - mx @ w))


def _kkt_solution(g: np.ndarray, c: np.ndarray, w: np.ndarray, l1: float, l2: float):
    """Exact minimiser on the support/signs of ``w`` if it satisfies the
    optimality conditions, else None."""
    act = np.flatnonzero(w)
    out = np.zeros_like(w)
    if len(act):
        sgn = np.sign(w[act])
        try:
            sol = np.linalg.solve(g[np.ix_(act, act)] + l2 * np.eye(len(act)), c[act] - l1 * sgn)
        except np.linalg.LinAlgError:
            return None
        if np.any(np.sign(sol) != sgn):
            return None
        out[act] = sol
    grad = c - g @ out - l2 * out          # subgradient condition off the support
    rest = np.setdiff1d(np.arange(len(w)), act)
    if len(rest) and np.any(np.abs(grad[rest]) > l1 * (1 + 1e-12) + 1e-15):
        return None
    return out


def elastic_net_fit(fs: FoldStats, st: Stats, alpha: float, l1_ratio: float,
                    max_iter: int = 100_000, tol: float = 1e-12) -> LinearFit:
    """Cyclic coordinate descent on the Gram (covariance updates), finished by
    an exact solve on the detected support once it satisfies the KKT
    conditions (correlated columns make plain CD crawl)."""
    mx, my, cxx, cxy = st.centred()
    n = st.n
    g, c = cxx / n, cxy / n
    d = len(c)
    w = np.zeros(d)
    l1, l2 = alpha * l1_ratio, alpha * (1.0 - l1_ratio)
    for it in range(max_iter):
        delta = 0.0
        for j in range(d):
            if g[j, j] + l2 == 0:
                continue
            rho = c[j] - g[j] @ w + g[j, j] * w[j]
            new = np.sign(rho) * max(abs(rho) - l1, 0.0) / (g[j, j] + l2)
            delta = max(delta, abs(new - w[j]))
            w[j] = new
        if delta <= tol * max(1.0, np.max(np.abs(w))):
            exact = _kkt_solution(g, c, w, l1, l2)
            w = w if exact is None else exact
            break
        if it % 5 == 4:
            exact = _kkt_solution(g, c, w, l1, l2)
            if exact is not None:
                w = exact
                break
    return LinearFit(w, float(my - mx @ w))


def fold_case(fold_col: str, per_fold: dict, features: Sequence[str]) -> Column:
    """``CASE fold WHEN i THEN prediction of model i END``."""
    expr = None
    for f, fit in sorted(per_fold.items()):
        p = fit.predict(features)
        expr = F.when(F.col(fold_col) == F.lit(f), p) if expr is None else \
            expr.when(F.col(fold_col) == F.lit(f), p)
    return expr


def mean_model(fits: Sequence[LinearFit]) -> LinearFit:
    """Average of fold models: the mean of their predictions on a row."""
    return LinearFit(np.mean([f.coef for f in fits], axis=0),
                     float(np.mean([f.intercept for f in fits])))


def mllib_penalty(alpha: float, l1_ratio: float, n: float, label_std: float,
                  ridge: bool = False) -> tuple[float, float]:
    """(regParam, elasticNetParam) for MLlib ``LinearRegression`` with
    ``standardization=False`` reproducing the objectives above.

    MLlib scales only the L2 part by the label's standard deviation
    (population for ``solver='normal'``, sample for ``'l-bfgs'``).
    """
    if ridge:
        a, b = 0.0, (alpha / n) * label_std
    else:
        a, b = alpha * l1_ratio, alpha * (1.0 - l1_ratio) * label_std
    reg = a + b
    return reg, (a / reg if reg > 0 else 0.0)
