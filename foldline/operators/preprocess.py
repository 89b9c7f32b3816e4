"""Per-fold preprocessors: tree (median impute + mode impute + one-hot) and
linear (the same plus standardisation), fitted on the training rows of each
held-out fold.

All ``k`` fold fits come from single passes over the data:

* medians: bracketed by mergeable per-fold sketches, then ranked exactly among
  the few values inside (:mod:`foldline.operators.quantiles`);
* modes / one-hot vocabularies: training-fold counts per ``(column, value)``;
* mean and population std of the *imputed* column: per-fold counts, means
  and ``var_pop`` merged pairwise on the driver, plus the missing rows at
  the fold's median.

The fitted statistics are small (``k x columns`` numbers plus category
lists) and are applied as literal Column expressions, one ``select``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldline.functions.columns import map_values
from foldline.operators.encode import FoldCategories, FoldCategoriesModel
from foldline.operators.impute import stacked_counts
from foldline.operators.quantiles import complement_counts, mode_from_counts, percentile_from_counts
from foldline.session import cut_lineage


#: Quantiles of a fold's sketch of a column, and the sketch's accuracy (a rank is off by n / accuracy at most).
GRID, ACCURACY = 200, 10_000
#: Values inside brackets that a task holds before it sends them on.
HELD_VALUES = 1 << 18


def _brackets(sketch: dict, folds: Sequence[int], p: float) -> tuple[float, float, int]:
    """(low, high, n): the values at the ranks around ``p`` of all rows of ``folds`` lie in low..high.

    ``sketch[g]`` is (row count, quantiles at i / GRID) of one fold. With a rank
    error of e, fewer than i / GRID * n + e rows lie below quantile i, and at least
    i / GRID * n - e not above it.
    """
    own = [(n, np.array(q), 2.0 * n / ACCURACY + 2) for n, q in (sketch[g] for g in folds) if n]
    total = sum(n for n, _, _ in own)
    if not total:
        return 0.0, 0.0, 0
    values = np.unique(np.concatenate([q for _, q, _ in own]))
    below, upto = np.zeros(len(values)), np.zeros(len(values))
    for n, q, e in own:
        first = np.searchsorted(q, values, "left")       # the first quantile that isn't smaller
        last = np.searchsorted(q, values, "right") - 1   # the last one that isn't larger
        below += np.where(first < len(q), np.minimum(n, first / GRID * n + e), n)
        upto += np.where(last >= 0, np.maximum(0, last / GRID * n - e), 0)
    rank = (total - 1) * p
    low, high = np.flatnonzero(below <= np.floor(rank)), np.flatnonzero(upto >= np.ceil(rank) + 1)
    return float(values[low[-1]]) if len(low) else -np.inf, float(values[high[0]]) if len(high) else np.inf, total


def fold_medians(df: DataFrame, cols: Sequence[str], fold_col: str, k: int) -> dict:
    """``(fold, column) -> exact median`` over the rows of the other folds.

    One aggregation sketches each column by fold, and the merged sketches of the
    training folds bracket each median. A pass over the columns as they lie counts the
    rows below each bracket; only values inside, a few thousandths of the rows, are shuffled,
    equal ones of a task together, and ranked with what lies below and above.
    """
    cols = list(cols)
    if not cols:
        return {}
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in cols])
    wide = df.where(F.col(fold_col).isNotNull()).select(F.col(fold_col).cast("int").alias("fold"), *[F.col(c).cast("double").alias(f"_{j}") for j, c in enumerate(cols)])
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"_{j}").alias("value")) for j, c in enumerate(cols)])
    long = wide.select("fold", F.inline(pairs)).where(F.col("value").isNotNull() & ~F.isnan("value"))
    sketch: dict = {c: {} for c in cols}
    grid = [i / GRID for i in range(GRID + 1)]
    for r in long.groupBy("fold", "name").agg(F.count("value").alias("n"), F.percentile_approx("value", grid, ACCURACY).alias("q")).collect():
        sketch[r["name"]][r["fold"]] = (r["n"], r["q"])
    brackets = {}
    for c in cols:
        for f in range(k):
            low, high, n = _brackets(sketch[c], [g for g in sketch[c] if g != f], 0.5)
            if n:
                brackets[f, c] = (low, high, n)
    if not brackets:
        return {}
    out = _ranked(wide, cols, brackets)
    missed = {key: (-np.inf, np.inf, brackets[key][2]) for key, m in out.items() if m is None}
    return out | (_ranked(wide, cols, missed) if missed else {})


def _inside(cols: Sequence[str], brackets: dict):
    """(fold, name, value, w) of the training values inside each bracket, equal ones together, and with value None the rows below it."""
    def rows(held: dict) -> pa.RecordBatch:
        out = [(f, c, np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True), np.concatenate([w for _, w in parts])) for (f, c), parts in held.items()]
        sums = [(f, c, v, np.bincount(at, weights=w, minlength=len(v)).astype(np.int64)) for f, c, (v, at), w in out]
        return pa.RecordBatch.from_arrays([pa.array([f for f, _, v, _ in sums for _ in v], pa.int32()), pa.array([c for _, c, v, _ in sums for _ in v], pa.string()),
                                           pa.array(np.concatenate([v for _, _, v, _ in sums])), pa.array(np.concatenate([w for *_, w in sums]))], ["fold", "name", "value", "_w"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        below, size = dict.fromkeys(brackets, 0), 0
        for batch in batches:
            fold = batch["fold"].to_numpy(zero_copy_only=False)
            for j, c in enumerate(cols):
                v = batch[f"_{j}"].to_numpy(zero_copy_only=False)  # a missing value is NaN: in no bracket and below none
                for f in sorted({f for f, name in brackets if name == c}):
                    low, high, _ = brackets[f, c]
                    own = v[fold != f]
                    below[f, c] += int((own < low).sum())
                    own = own[(own >= low) & (own <= high)]
                    if len(own):
                        values, counts = np.unique(own, return_counts=True)
                        held.setdefault((f, c), []).append((values, counts))
                        size += len(values)
            if size > HELD_VALUES:
                yield rows(held)
                held, size = {}, 0
        if held:
            yield rows(held)
        yield pa.RecordBatch.from_pydict({"fold": [f for f, _ in below], "name": [c for _, c in below], "value": [None] * len(below), "_w": list(below.values())},
                                         pa.schema([("fold", pa.int32()), ("name", pa.string()), ("value", pa.float64()), ("_w", pa.int64())]))
    return run


def _ranked(wide: DataFrame, cols: Sequence[str], brackets: dict) -> dict:
    """The median of every (fold, column) in ``brackets`` from rows (fold, a column _j for each of ``cols``); None where it turns out to lie outside."""
    spark = wide.sparkSession
    found = wide.mapInArrow(_inside(cols, brackets), "fold int, name string, value double, _w long")
    counts = cut_lineage(found.groupBy("fold", "name", "value").agg(F.sum("_w").alias("_w")))
    sums = {(r["fold"], r["name"], r["below"]): r["w"] for r in counts.groupBy("fold", "name", F.col("value").isNull().alias("below")).agg(F.sum("_w").alias("w")).collect()}
    outside, inside = [], set()
    for (f, c), (_, _, n) in brackets.items():
        below = sums.get((f, c, True), 0)
        above = n - below - sums.get((f, c, False), 0)
        if below <= (n - 1) // 2 and above <= (n - 1) // 2:  # both ranks of the median lie inside
            outside += [(f, c, v, w) for v, w in ((float("-inf"), below), (float("inf"), above)) if w]
            inside.add((f, c))
    kept = counts.where(F.col("value").isNotNull())
    whole = kept.unionByName(spark.createDataFrame(outside, "fold int, name string, value double, _w long")) if outside else kept
    medians = {(r["fold"], r["name"]): r["median"] for r in percentile_from_counts(whole, ["fold", "name"], "value", 0.5, "median").collect()}
    return {key: medians[key] if key in inside else None for key in brackets}


def fold_medians_approx(df: DataFrame, cols: Sequence[str], fold_col: str, k: int,
                        accuracy: int = 10_000) -> dict:
    """Approximate training-fold medians (``percentile_approx``): each row is
    sent to the ``k - 1`` folds it trains and fixed-size sketches are merged
    map-side, so the shuffle carries sketches instead of distinct values.
    Rank error is at most ``n / accuracy``."""
    if not cols:
        return {}
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value"))
                      for c in cols])
    others = F.filter(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: i != F.col(fold_col))
    long = (df.select(fold_col, F.inline(pairs)).where(F.col("value").isNotNull())
            .withColumn("fold_t", F.explode(others)))
    med = long.groupBy("fold_t", "name").agg(
        F.percentile_approx("value", 0.5, accuracy).alias("median"))
    return {(r["fold_t"], r["name"]): r["median"] for r in med.collect()}


def fold_modes(df: DataFrame, cols: Sequence[str], fold_col: str, k: int) -> dict:
    """``(fold, column) -> most frequent training value`` (ties -> smallest)."""
    if not cols:
        return {}
    counts = stacked_counts(df, cols, [fold_col])
    train = complement_counts(counts, fold_col, k, "fold")
    modes = mode_from_counts(train, ["fold", "name"], "value", "mode")
    return {(r["fold"], r["name"]): r["mode"] for r in modes.collect()}


def _merge(a, b):
    """Pairwise merge of (count, mean, sum of squared deviations)."""
    (na, ma, qa), (nb, mb, qb) = a, b
    n = na + nb
    if n == 0:
        return (0, 0.0, 0.0)
    d = mb - ma
    return (n, ma + d * nb / n, qa + qb + d * d * na * nb / n)


def fold_moments(df: DataFrame, cols: Sequence[str], fold_col: str, medians: dict,
                 k: int) -> dict:
    """``(fold, column) -> (mean, scale)`` of the median-imputed training column.

    One pass: per fold, the row count and, per column, the non-NULL count,
    mean and ``var_pop`` (Spark's stable single-pass aggregates). The other
    folds are merged pairwise, then the ``m`` missing rows join as a group
    of ``m`` values at the fold's median (zero spread).
    """
    if not cols:
        return {}
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(c).alias(f"nn{i}"), F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}")]
    per = {r[fold_col]: r for r in df.groupBy(fold_col).agg(*aggs).collect()}
    out = {}
    for f in range(k):
        others = [r for g, r in sorted(per.items()) if g != f]
        n = sum(r["n"] for r in others)
        for i, c in enumerate(cols):
            acc = (0, 0.0, 0.0)
            for r in others:
                if r[f"nn{i}"]:
                    acc = _merge(acc, (r[f"nn{i}"], r[f"m{i}"], (r[f"v{i}"] or 0.0) * r[f"nn{i}"]))
            med = medians.get((f, c))
            if n == 0 or med is None:
                out[(f, c)] = (0.0, 1.0)
                continue
            cnt, mean, q = _merge(acc, (n - acc[0], med, 0.0))
            std = math.sqrt(max(q / cnt, 0.0))
            scale = std if std > 10 * 2.220446049250313e-16 * max(1.0, abs(mean)) else 1.0
            out[(f, c)] = (mean, scale)
    return out


@dataclass
class FoldPreprocessModel:
    numeric: list
    categorical: list
    kind: str                                  # "tree", "linear" or "native"
    medians: dict = field(default_factory=dict)
    modes: dict = field(default_factory=dict)
    vocab: FoldCategoriesModel = field(default_factory=FoldCategoriesModel)
    moments: dict = field(default_factory=dict)

    def numeric_expr(self, fold: int, c: str) -> Column:
        med = self.medians.get((fold, c))
        x = F.coalesce(F.col(c).cast("double"), F.lit(med)) if med is not None else \
            F.col(c).cast("double")
        if self.kind == "linear":
            mean, scale = self.moments.get((fold, c), (0.0, 1.0))
            x = (x - F.lit(mean)) / F.lit(scale)
        return x

    def native_columns(self, fold: int) -> dict:
        """Numerics with NULL -> 0; categories (NULL -> 'Missing') as nominal
        indices carrying ML attribute metadata, so trees split on them as
        categories. Values unseen in the training folds get one extra index."""
        out = {f"num__{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in self.numeric}
        for c in self.categorical:
            cats = self.vocab.categories.get((fold, c), [])
            v = F.coalesce(F.col(c).cast("string"), F.lit("Missing"))
            idx = F.coalesce(map_values(v, {x: i for i, x in enumerate(cats)}, None),
                             F.lit(len(cats))).cast("double")
            meta = {"ml_attr": {"type": "nominal", "name": f"cat__{c}",
                                "vals": [str(x) for x in cats] + ["__unseen__"]}}
            out[f"cat__{c}"] = idx.alias(f"cat__{c}", metadata=meta)
        return out

    def max_categories(self) -> int:
        return max([len(v) + 1 for v in self.vocab.categories.values()] or [2])

    def columns(self, fold: int) -> dict:
        """Output column name -> expression for the model of ``fold``."""
        if self.kind == "native":
            return self.native_columns(fold)
        out = {f"num__{c}": self.numeric_expr(fold, c) for c in self.usable(fold)}
        for c in self.categorical:
            mode = self.modes.get((fold, c))
            v = F.coalesce(F.col(c), F.lit(mode)) if mode is not None else F.col(c)
            for j, cat in enumerate(self.vocab.categories.get((fold, c), [])):
                out[f"cat__{c}__{j}"] = F.coalesce((v == F.lit(cat)).cast("double"), F.lit(0.0))
        return out

    def usable(self, fold: int) -> list:
        """Numeric columns with a value in the fold's training rows; the others are dropped."""
        return [c for c in self.numeric if self.medians.get((fold, c)) is not None]

    def transform(self, df: DataFrame, fold: int, keep: Sequence[str]) -> DataFrame:
        cols = self.columns(fold)
        return df.select(*keep, *[_named(e, n) for n, e in cols.items()])

    def n_features(self, fold: int) -> int:
        cats = sum(len(self.vocab.categories.get((fold, c), [])) for c in self.categorical)
        return len(self.numeric) + len(self.categorical) if self.kind == "native" else len(self.usable(fold)) + cats

    def index_columns(self, fold: int) -> dict:
        """Per category: position of the mode-imputed value in the fold's
        vocabulary, unseen -> one extra last slot; nominal ML metadata."""
        out = {}
        for c in self.categorical:
            cats = self.vocab.categories.get((fold, c), [])
            mode = self.modes.get((fold, c))
            v = F.coalesce(F.col(c), F.lit(mode)) if mode is not None else F.col(c)
            idx = F.coalesce(map_values(v, {x: i for i, x in enumerate(cats)}, None),
                             F.lit(len(cats))).cast("double")
            meta = {"ml_attr": {"type": "nominal", "name": f"idx__{c}",
                                "vals": [str(x) for x in cats] + ["__unseen__"]}}
            out[f"idx__{c}"] = idx.alias(f"idx__{c}", metadata=meta)
        return out

    def features(self, df: DataFrame, fold: int, keep: Sequence[str],
                 out_col: str = "features") -> DataFrame:
        """One vector column for the model of ``fold``.

        Tree / linear kinds one-hot the categories with MLlib's
        ``OneHotEncoder`` over nominal index columns (``dropLast`` removes
        the unseen slot, so unseen and NULL become all-zero, as
        ``handle_unknown='ignore'``); the encoder reads the category count
        from the column metadata, so fitting it runs no job, and the vectors
        stay sparse.
        """
        if self.kind == "native":
            cols = self.columns(fold)
            wide = df.select(*keep, *[_named(e, n) for n, e in cols.items()])
            inputs = list(cols)
        else:
            nums = {f"num__{c}": self.numeric_expr(fold, c) for c in self.usable(fold)}
            idx = self.index_columns(fold)
            wide = df.select(*keep, *[e.alias(n) for n, e in nums.items()], *idx.values())
            if idx:
                enc = OneHotEncoder(inputCols=list(idx), outputCols=[f"oh__{n[5:]}" for n in idx],
                                    dropLast=True, handleInvalid="error")
                wide = enc.fit(wide).transform(wide)
            inputs = list(nums) + [f"oh__{n[5:]}" for n in idx]
        va = VectorAssembler(inputCols=inputs, outputCol=out_col, handleInvalid="keep")
        return va.transform(wide).select(*keep, out_col)


def _named(e: Column, n: str) -> Column:
    # native category columns already carry their alias and metadata
    return e if n.startswith("cat__") and "__" not in n[5:] else e.alias(n)


class FoldPreprocessor:
    """``median='exact'`` (default, as the reference) or ``'approx'`` for very
    large continuous columns (sketch-based, bounded shuffle)."""

    def __init__(self, numeric: Sequence[str], categorical: Sequence[str], kind: str = "tree",
                 fold_col: str = "fold", k: int = 5, median: str = "exact"):
        assert kind in ("tree", "linear", "native") and median in ("exact", "approx")
        self.numeric, self.categorical = list(numeric), list(categorical)
        self.kind, self.fold_col, self.k, self.median = kind, fold_col, k, median

    def fit(self, df: DataFrame) -> FoldPreprocessModel:
        med = (fold_medians if self.median == "exact" else fold_medians_approx)(
            df, self.numeric, self.fold_col, self.k)
        modes = fold_modes(df, self.categorical, self.fold_col, self.k)
        vocab = self._vocabulary(df, self.kind)
        mom = fold_moments(df, self.numeric, self.fold_col, med, self.k) \
            if self.kind == "linear" else {}
        return FoldPreprocessModel(self.numeric, self.categorical, self.kind, med, modes, vocab, mom)

    def _vocabulary(self, df: DataFrame, kind: str) -> FoldCategoriesModel:
        """Categories of each fold; for native models a missing one is the category 'Missing'."""
        if not self.categorical:
            return FoldCategoriesModel()
        if kind == "native":
            df = df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("Missing")) for c in self.categorical})
        return FoldCategories(self.categorical, self.fold_col, self.k).fit(df)

    def with_kind(self, model: FoldPreprocessModel, kind: str, df: DataFrame) -> FoldPreprocessModel:
        """Reuse the imputation statistics for another kind (adds moments)."""
        mom = fold_moments(df, self.numeric, self.fold_col, model.medians, self.k) \
            if kind == "linear" and not model.moments else model.moments
        vocab = model.vocab if (kind == "native") == (model.kind == "native") else self._vocabulary(df, kind)
        return FoldPreprocessModel(model.numeric, model.categorical, kind, model.medians,
                                   model.modes, vocab, mom)
