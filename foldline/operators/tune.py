"""Hyper-parameter search.

``elastic_net_search``: cross-validated elastic-net meta model over many
(alpha, l1_ratio) candidates. The per-fold Gram statistics are computed in
one pass; every (candidate, fold) model is solved on the driver (``d x d``);
the original-scale MAE of *all* candidates is then one more pass (one
aggregate per candidate). Candidates are drawn log-uniform in alpha and
uniform in l1_ratio from a seeded generator.

``gbt_search`` and ``halving_search``: randomised search over boosted trees,
plain and by successive halving over rungs of rounds; every fold is fitted and
scored with the preprocessing statistics of its own training rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldline.operators.boosting import BoostParams, fit_boosted, with_overrides
from foldline.operators.linear import (elastic_net_fit, fold_case, fold_stats, ridge_fit)
from foldline.operators.metrics import abs_error


def sample_candidates(n_trials: int, seed: int = 42, alpha_range=(1e-4, 1.0)):
    rng = np.random.default_rng(seed)
    lo, hi = np.log(alpha_range[0]), np.log(alpha_range[1])
    alphas = np.exp(rng.uniform(lo, hi, n_trials))
    l1s = rng.uniform(0.0, 1.0, n_trials)
    return [(float(a), float(r)) for a, r in zip(alphas, l1s)]


def enet_fold_fit(fs, fold, alpha: float, l1_ratio: float):
    st = fs.train(fold)
    if l1_ratio == 0.0:
        # 1/(2n)||r||^2 + alpha/2 ||w||^2  ==  ridge with penalty n * alpha
        return ridge_fit(fs, st, alpha * st.n)
    return elastic_net_fit(fs, st, alpha, l1_ratio)


def elastic_net_search(wide: DataFrame, features: Sequence[str], candidates,
                       label: str = "label", fold_col: str = "fold",
                       objective: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """``trial, alpha, l1_ratio, mae`` for every candidate (CV, original scale).

    ``objective(label, prediction) -> Column`` replaces the per-row error
    (default: absolute error after ``expm1``); it is averaged over rows.
    """
    fs = fold_stats(wide, features, label, fold_col)
    folds = sorted(fs.per_fold)
    y = F.col(label)
    err = objective or abs_error
    aggs = []
    for t, (a, r) in enumerate(candidates):
        fits = {f: enet_fold_fit(fs, f, a, r) for f in folds}
        aggs.append(F.avg(err(y, fold_case(fold_col, fits, features))).alias(f"t{t}"))
    wide_row = wide.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(t).alias("trial"), F.lit(a).alias("alpha"),
                              F.lit(r).alias("l1_ratio"), F.col(f"t{t}").alias("mae"))
                     for t, (a, r) in enumerate(candidates)])
    return wide_row.select(F.inline(rows))


def best_trial(results: DataFrame) -> DataFrame:
    """Lowest MAE; ties -> lowest trial number."""
    best = F.min_by(F.struct("trial", "alpha", "l1_ratio", "mae"), F.struct("mae", "trial"))
    return results.agg(best.alias("b")).select("b.*")


def sample_gbt(n_trials: int, seed: int = 42, depths: Sequence[int] = (3, 4, 5, 6),
               step_range=(0.01, 0.3)) -> list[dict]:
    """Depth uniform in ``depths``, step size log-uniform in ``step_range``."""
    rng = np.random.default_rng(seed)
    lo, hi = np.log(step_range[0]), np.log(step_range[1])
    return [{"maxDepth": int(rng.choice(depths)), "stepSize": float(np.exp(rng.uniform(lo, hi)))}
            for _ in range(n_trials)]


def gbt_search(train: DataFrame, prep, candidates: Sequence[dict], id_col: str = "id", label: str = "label",
               fold_col: str = "fold", k: int = 5, rounds: int = 5000, seed: int = 42,
               parallelism: int = 4, log_scale: bool = True, patience: int | None = None) -> list[dict]:
    """Each candidate's parameters with ``cv_mae``: absolute error on the original scale, averaged over all held-out rows.

    ``prep`` is a fitted :class:`~foldline.operators.preprocess.FoldPreprocessModel`.
    A candidate's folds are boosted together; candidates are independent jobs from
    a small thread pool. Without any held-out row ``cv_mae`` is None.
    """
    start = BoostParams(rounds=rounds, subsample=0.71, patience=patience, seed=seed)

    def one(params: dict) -> float | None:
        fit = fit_boosted(train, prep, with_overrides(start, params), id_col, label, fold_col, k)
        rows = fit.attach(train.where(F.col(label).isNotNull()), "_pred", True)
        return rows.agg(F.avg(abs_error(F.col(label), F.col("_pred"), log_scale))).first()[0]

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return [params | {"cv_mae": mae} for params, mae in zip(candidates, pool.map(one, candidates), strict=True)]


def halving_search(train: DataFrame, prep, candidates: Sequence[dict], id_col: str, label: str = "label", fold_col: str = "fold",
                   k: int = 5, rounds: int = 50, factor: int = 3, most: int = 5000, seed: int = 42, log_scale: bool = True,
                   patience: int | None = None) -> list[dict]:
    """Successive halving: all candidates at ``rounds``, the best 1 / ``factor`` of them at ``factor`` times as many, until one is left
    or ``most`` rounds are reached. One row for each fit: trial, rounds, depth, step, cv_mae; the last row is the winner.

    Ties go to the earlier candidate. With the rounds of one full rung a plain
    search tries fewer candidates to the end; here the budget goes to those that lead.
    """
    alive, out = list(enumerate(candidates)), []
    while alive:
        fits = gbt_search(train, prep, [c for _, c in alive], id_col, label, fold_col, k, rounds, seed, log_scale=log_scale, patience=patience)
        scored = sorted(zip(alive, fits, strict=True), key=lambda x: (float("inf") if x[1]["cv_mae"] is None else x[1]["cv_mae"], x[0][0]))
        out += [{"trial": t, "rounds": rounds, "depth": f["maxDepth"], "step": f["stepSize"], "cv_mae": f["cv_mae"]} for (t, _), f in reversed(scored)]
        if len(alive) == 1 or rounds >= most:
            break
        alive, rounds = sorted(x[0] for x in scored[:max(1, len(alive) // factor)]), min(most, rounds * factor)
    return out
