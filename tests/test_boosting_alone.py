"""Ensembles that one task grows, against those grown a job for each level."""

import numpy as np
import pytest

from foldline.operators import boosting
from foldline.operators.boosting import Alone, BoostParams, fit_boosted
from foldline.operators.preprocess import FoldPreprocessor

K = 3


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(9)
    out = []
    for i in range(700):
        a, b, c = float(rng.integers(0, 30)), float(rng.normal()), "xyz"[int(rng.integers(0, 3))]
        y = None if i % 31 == 0 else (a > 12) * 2.0 + (c == "y") + 0.4 * b * (a > 5) + float(rng.normal(scale=0.2))
        out.append((i, i % K, None if i % 17 == 0 else a, b if i % 19 else float("nan"), None if i % 23 == 0 else c, y))
    return spark.createDataFrame(out, "id long, fold int, a double, b double, c string, label double").repartition(3).cache()


@pytest.mark.parametrize("kind, p", [
    ("tree", BoostParams(rounds=4, step=0.3, depth=4, subsample=0.7, colsample=0.6, l1=0.03, l2=0.2, min_child=2, min_gain=0.01, patience=2)),
    ("native", BoostParams(rounds=4, step=0.3, depth=3, symmetric=True, loss="absolute", l2=2.0, bagging_temperature=0.5, patience=None)),
    ("tree", BoostParams(rounds=3, step=0.4, depth=5, leaves=7, min_child=3, patience=None)),
])
def test_one_task_grows_the_trees_of_the_jobs(rows, kind, p, monkeypatch):
    prep = FoldPreprocessor(["a", "b"], ["c"], kind, "fold", K).fit(rows)
    alone = fit_boosted(rows, prep, p, "id", k=K)
    monkeypatch.setattr(boosting, "ALONE_BYTES", 0)
    jobs = fit_boosted(rows, prep, p, "id", k=K)
    for f in range(K):
        assert [[list(c) for c in vars(t).values()] for t in alone.trees[f]] == [[list(c) for c in vars(t).values()] for t in jobs.trees[f]]
        assert alone.errors[f] == pytest.approx(jobs.errors[f], rel=1e-12)


def test_a_small_table_needs_no_job_for_a_level(spark, rows):
    """Forty rounds of depth 4 took 160 jobs and more."""
    prep = FoldPreprocessor(["a", "b"], ["c"], "tree", "fold", K).fit(rows)
    spark.sparkContext.setJobGroup("alone", "boosting")
    try:
        fit = fit_boosted(rows, prep, BoostParams(rounds=40, depth=4, patience=None), "id", k=K)
        assert all(fit.rounds(f) == 40 for f in range(K))
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("alone")) < 20
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_large_sums_are_not_subtracted(rows, monkeypatch):
    """Labels whose sums are not exact: every child is summed of its own, in both ways the same tree."""
    prep = FoldPreprocessor(["a", "b"], ["c"], "tree", "fold", K).fit(rows)
    big = rows.withColumn("label", rows.label * 2.0 ** 20)
    asked = []
    sums = Alone.sums
    monkeypatch.setattr(Alone, "sums", lambda self, bundles, rows, at, slot, n, g, h: asked.append(n) or sums(self, bundles, rows, at, slot, n, g, h))
    from foldline.operators.boosting import _pieces, fit_binning
    kept = big.where("label is not null")
    binning = fit_binning(kept, prep, "id", K, 64)
    binned, n = _pieces(kept, binning, "id", "label", "fold")
    one = Alone(0, binned.collect(), n, [0.0] * K, binning, BoostParams(rounds=1, depth=3, patience=None), K)
    trees, _ = one.fit()
    assert asked == [1, 2, 4] and trees[0].n_leaves == 8
