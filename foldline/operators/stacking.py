"""Out-of-fold predictions, the prediction table and the meta model.

``fit_folds`` fits a model for each held-out fold on the rows of the others.
The scorer it returns adds one column to a table: each training row's prediction
by the model that didn't see it, or the mean of the fold models. All fold models
sit in one projection, so a table is scanned once however many models are added
to it, and nothing is shuffled; the prediction table is the training table with a
column for each model.

The meta step works on that wide table; its fits use the Gram statistics of
:mod:`foldline.operators.linear` (one pass, ``d x d`` on the driver).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldline.operators.boosting import BoostedFolds, fit_boosted, with_overrides
from foldline.operators.forest import MLLIB_NODES, ForestFolds, fit_forest
from foldline.operators.gram import GramFolds, fit_gram
from foldline.operators.linear import elastic_net_fit, fold_stats, ridge_fit
from foldline.operators.metrics import abs_error, pct_error
from foldline.operators.models import FitContext, ModelSpec
from foldline.operators.preprocess import FoldPreprocessModel, _merge


def label_context(df: DataFrame, label: str, fold_col: str, k: int) -> dict:
    """Per held-out fold: training row count and population std of the label."""
    per = {r[fold_col]: r for r in df.groupBy(fold_col).agg(
        F.count(label).alias("n"), F.avg(label).alias("m"), F.var_pop(label).alias("v")).collect()}
    out = {}
    for f in range(k):
        acc = (0, 0.0, 0.0)
        for g, r in sorted(per.items()):
            if g != f and r["n"]:
                acc = _merge(acc, (r["n"], r["m"], r["v"] * r["n"]))
        out[f] = FitContext(float(acc[0]), math.sqrt(acc[2] / acc[0]) if acc[0] else 0.0)
    return out


@dataclass
class FoldScorer:
    """MLlib models of all folds, applied in one projection."""
    models: list
    prep: FoldPreprocessModel
    fold_col: str

    def attach(self, df: DataFrame, out_col: str, own_fold: bool) -> DataFrame:
        """``df`` with a prediction: by the model of the row's fold, or the mean of all models."""
        keep, wide = df.columns, df
        for i, model in enumerate(self.models):
            wide = self.prep.features(wide, i, wide.columns, f"_x{i}")
            wide = model.transform(wide, {model.featuresCol: f"_x{i}", model.predictionCol: f"_p{i}"}).drop(f"_x{i}")
        preds = [F.col(f"_p{i}") for i in range(len(self.models))]
        if own_fold:
            pred = F.lit(None).cast("double")
            for i, p in enumerate(preds):
                pred = F.when(F.col(self.fold_col) == F.lit(i), p).otherwise(pred)
        else:
            pred = sum(preds[1:], preds[0]) / F.lit(float(len(preds)))
        return wide.select(*keep, pred.alias(out_col))


def fit_folds(spec: ModelSpec, prep: FoldPreprocessModel, train: DataFrame, id_col: str, label: str = "label", fold_col: str = "fold",
              k: int = 5, params: dict | None = None, parallelism: int = 5) -> FoldScorer | BoostedFolds | GramFolds | ForestFolds:
    """The fold models of ``spec``: boosted or solved all at once, a deep forest tree by tree, or MLlib fits from a small thread pool.

    With ``uses_validation`` an estimator gets all rows and the held-out ones marked ``is_val``.
    """
    params = dict(params or {})
    if spec.boost is not None:
        return fit_boosted(train, prep, with_overrides(spec.boost, params), id_col, label, fold_col, k)
    if spec.gram is not None:
        return fit_gram(train, prep, params.get("alpha", spec.gram[0]), params.get("l1_ratio", spec.gram[1]), label, fold_col, k)
    if spec.forest is not None:
        asked = replace(spec.forest, **{c: v for c, v in params.items() if hasattr(spec.forest, c)})
        forest = fit_forest(train, prep, asked, id_col, label, fold_col, k) if asked.numTrees << asked.maxDepth > MLLIB_NODES else None
        if forest is not None:
            return forest
    if prep.kind == "native":
        params.setdefault("maxBins", max(64, prep.max_categories() + 1))
    ctx = label_context(train, label, fold_col, k)

    def one_fold(i: int):
        fx = prep.features(train, i, [id_col, fold_col, label])
        est = spec.build(FitContext(ctx[i].n_train, ctx[i].label_std_pop, prep.n_features(i)), params)
        rows = fx.withColumn("is_val", F.col(fold_col) == F.lit(i)) if spec.uses_validation else fx.where(F.col(fold_col) != F.lit(i))
        return est.fit(rows.withColumnRenamed(label, "label") if label != "label" else rows)

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, k))) as pool:
        return FoldScorer(list(pool.map(one_fold, range(k))), prep, fold_col)


def oof_predict(spec: ModelSpec, prep: FoldPreprocessModel, train: DataFrame,
                score: DataFrame | None, id_col: str, label: str = "label",
                fold_col: str = "fold", k: int = 5, params: dict | None = None,
                parallelism: int = 5):
    """Returns ``(oof, score_mean)``: long ``(id, fold, label, model, pred)`` for
    the training rows and ``(id, model, pred)`` averaged over fold models."""
    scorer = fit_folds(spec, prep, train, id_col, label, fold_col, k, params, parallelism)
    name = F.lit(spec.name).alias("model")
    oof = scorer.attach(train, "pred", True).select(id_col, fold_col, label, name, "pred")
    return oof, None if score is None else scorer.attach(score, "pred", False).select(id_col, name, "pred")


def prediction_table(scorers: dict[str, FoldScorer | BoostedFolds | GramFolds | ForestFolds], df: DataFrame, keep: Sequence[str], own_fold: bool) -> DataFrame:
    """``keep`` and a column for each model's prediction, from one scan of ``df``."""
    out = df
    for i, scorer in enumerate(scorers.values()):
        out = scorer.attach(out, f"_model{i}", own_fold)  # a model may have the name of a feature
    return out.select(*keep, *[F.col(f"_model{i}").alias(name) for i, name in enumerate(scorers)])


def long_predictions(wide: DataFrame, models: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """(keep..., model, pred) from a prediction table, row by row."""
    pairs = F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("pred")) for m in models])
    return wide.select(*keep, F.inline(pairs))


def meta_matrix(long: DataFrame, id_col: str, models: Sequence[str],
                keys: Sequence[str] = ("fold", "label")) -> DataFrame:
    """Wide table ``id, keys..., <one column per model>`` from long predictions
    that come from elsewhere (one shuffle on the id); models fitted here get theirs
    from ``prediction_table``, without one."""
    keys = [k for k in keys if k in long.columns]
    return (long.groupBy(id_col, *keys).pivot("model", list(models))
            .agg(F.first("pred")))


@dataclass
class MetaResult:
    meta_name: str
    mae: float
    mape: float
    coefs: dict
    intercept: float
    ridge_mae: float
    enet_mae: float
    final_pred: DataFrame | None


def evaluate_meta(wide: DataFrame, models: Sequence[str], label: str = "label",
                  score_wide: DataFrame | None = None, id_col: str = "id",
                  ridge_alpha: float = 1.0, enet_alpha: float = 0.001,
                  enet_l1: float = 0.5) -> MetaResult:
    """Ridge(1.0) vs ElasticNet(0.001, 0.5) on the prediction table; the error
    is measured on the same rows (in-sample, as the reference does); strict
    ``<`` so an equal error keeps Ridge."""
    fs = fold_stats(wide, models, label, fold_col=None)
    st = fs.per_fold[0]
    ridge = ridge_fit(fs, st, ridge_alpha)
    enet = elastic_net_fit(fs, st, enet_alpha, enet_l1)
    y = F.col(label)
    row = wide.agg(F.avg(abs_error(y, ridge.predict(models))).alias("r"),
                   F.avg(abs_error(y, enet.predict(models))).alias("e"),
                   F.avg(pct_error(y, ridge.predict(models))).alias("rp"),
                   F.avg(pct_error(y, enet.predict(models))).alias("ep")).first()
    if row["e"] < row["r"]:
        name, fit, mae, mape = "ElasticNet", enet, row["e"], row["ep"]
    else:
        name, fit, mae, mape = "Ridge", ridge, row["r"], row["rp"]
    final = None
    if score_wide is not None:
        final = score_wide.select(id_col, F.expm1(fit.predict(models)).alias("pred"))
    return MetaResult(name, mae, mape, {m: round(float(w), 4) for m, w in zip(models, fit.coef)},
                      fit.intercept, row["r"], row["e"], final)
