"""Base-model registry: name -> MLlib estimator factory and the preprocessing
it expects (``tree``, ``linear`` or ``native`` categories).

The boosted models run on :mod:`foldline.operators.boosting`, all folds at
once and with patience; the linear ones on :mod:`foldline.operators.gram`, all
folds from one pass (their MLlib estimators stay as ``build``); randomised split thresholds have no counterpart and are
re-aimed at MLlib's random forest (see README).
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.regression import LinearRegression, RandomForestRegressor

from foldline.operators.boosting import BoostParams
from foldline.operators.forest import ForestParams
from foldline.operators.linear import mllib_penalty

log = logging.getLogger(__name__)

RANDOM_STATE = 42


# MLlib's normal-equation solver handles at most this many features.
NORMAL_SOLVER_MAX_FEATURES = 4096


@dataclass
class FitContext:
    """Training-fold facts some factories need (penalty conversion, solver)."""
    n_train: float
    label_std_pop: float
    n_features: int = 0

    @property
    def label_std_sample(self) -> float:
        n = self.n_train
        return self.label_std_pop * (n / (n - 1)) ** 0.5 if n > 1 else self.label_std_pop

    @property
    def solver(self) -> str:
        return "normal" if self.n_features <= NORMAL_SOLVER_MAX_FEATURES else "l-bfgs"

    @property
    def solver_label_std(self) -> float:
        # MLlib scales the L2 part by the population std (normal) or the sample std (l-bfgs)
        return self.label_std_pop if self.solver == "normal" else self.label_std_sample


@dataclass
class ModelSpec:
    """``build`` gives an MLlib estimator for one fold; with ``boost`` or ``gram`` all folds are fitted at once instead."""
    name: str
    prep: str                                   # tree | linear | native
    build: Callable[[FitContext, dict], object] | None = None
    uses_validation: bool = False
    boost: BoostParams | None = None
    gram: tuple[float, float | None] | None = None   # alpha, l1_ratio (None: ridge)
    forest: ForestParams | None = None               # deep forests; small ones are MLlib's


def _forest(ctx: FitContext, params: dict):
    return RandomForestRegressor(
        numTrees=params.get("numTrees", 800), maxDepth=params.get("maxDepth", 20),
        minInstancesPerNode=2, featureSubsetStrategy="onethird", subsamplingRate=1.0,
        bootstrap=False, seed=RANDOM_STATE, featuresCol="features", labelCol="label",
        maxBins=params.get("maxBins", 64))


def _ridge(alpha: float):
    def build(ctx: FitContext, params: dict):
        reg, enp = mllib_penalty(alpha, 0.0, ctx.n_train, ctx.solver_label_std, ridge=True)
        return LinearRegression(regParam=reg, elasticNetParam=enp, standardization=False,
                                solver=ctx.solver, fitIntercept=True, maxIter=params.get("maxIter", 1000),
                                tol=1e-9, featuresCol="features", labelCol="label")
    return build


def _lasso(alpha: float):
    def build(ctx: FitContext, params: dict):
        return LinearRegression(regParam=alpha, elasticNetParam=1.0, standardization=False,
                                solver=ctx.solver, fitIntercept=True,
                                maxIter=params.get("maxIter", 10000), tol=1e-9,
                                featuresCol="features", labelCol="label")
    return build


# The six base models of the active configuration.
REGISTRY: dict[str, ModelSpec] = {
    "XGBoost": ModelSpec("XGBoost", "tree", boost=BoostParams(
        rounds=5000, step=0.0156, depth=4, subsample=0.71, colsample=0.435, l1=0.0345, l2=0.162, min_child=2, min_gain=0.0027, patience=150)),
    "CatBoost": ModelSpec("CatBoost", "native", boost=BoostParams(
        rounds=6000, step=0.02, depth=6, symmetric=True, loss="absolute", l2=5, bagging_temperature=0.5, patience=100)),
    "ExtraTrees": ModelSpec("ExtraTrees", "tree", _forest, forest=ForestParams()),
    "LightGBM": ModelSpec("LightGBM", "tree", boost=BoostParams(
        rounds=8000, step=0.008, depth=4, leaves=20, subsample=0.7, colsample=0.6, l1=0.2, l2=2.0, min_child=10, patience=100)),
    "Linear_Ridge": ModelSpec("Linear_Ridge", "linear", _ridge(10.0), gram=(10.0, None)),
    "Linear_Lasso": ModelSpec("Linear_Lasso", "linear", _lasso(0.0005), gram=(0.0005, 1.0)),
}


def register_model(spec: ModelSpec, registry: dict | None = None) -> None:
    """Add a user model (any MLlib estimator, or boosting settings) under ``spec.name``."""
    (REGISTRY if registry is None else registry)[spec.name] = spec


def resolve(names, registry: dict | None = None) -> list[ModelSpec]:
    """Specs for the known names; unknown names are skipped with a warning."""
    reg = REGISTRY if registry is None else registry
    out = []
    for n in names:
        if n not in reg:
            log.warning("model %s is not in the registry; skipped", n)
            continue
        out.append(reg[n])
    return out
