"""Boosted folds: known trees, known error curves, patience, leaf counts, missing values and repeatability."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldline.operators import boosting
from foldline.operators.boosting import BoostParams, Tree, fit_boosted
from foldline.operators.models import ModelSpec
from foldline.operators.preprocess import FoldPreprocessor
from foldline.operators.stacking import fit_folds, oof_predict, prediction_table
from foldline.operators.encode import ordered_target_stats
from foldline.operators.tune import gbt_search, halving_search

K = 3


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    out = []
    for i in range(900):
        a, b, c = float(rng.integers(0, 40)), float(rng.normal()), "xyz"[int(rng.integers(0, 3))]
        y = (a > 20) * 2.0 + (c == "y") * 1.0 + 0.3 * b * (a > 10) + float(rng.normal(scale=0.1))
        out.append((i, i % K, None if i % 17 == 0 else a, b if i % 19 else float("nan"), None if i % 23 == 0 else c, float(y)))
    return spark.createDataFrame(out, "id long, fold int, a double, b double, c string, label double").repartition(4).cache()


@pytest.fixture(scope="module")
def prep(rows):
    return FoldPreprocessor(["a", "b"], ["c"], "tree", "fold", K).fit(rows)


def test_errors_are_those_of_the_prefixes_and_patience_ends_at_the_best(rows, prep):
    p = BoostParams(rounds=60, step=0.9, depth=4, subsample=0.7, patience=6, seed=1)
    fit = fit_boosted(rows, prep, p, "id", k=K)
    staged = {(r.fold, r.rounds): r.error for r in fit.staged_errors(rows).collect()}
    for f in range(K):
        errors = fit.errors[f]
        best = int(np.argmin(errors))
        assert fit.rounds(f) == best and len(errors) == min(best + 6, 60) + 1
        assert [staged[f, r] for r in range(best + 1)] == pytest.approx(errors[:best + 1], rel=1e-12)
        assert errors[best] < 0.2 * errors[0]
    # the out-of-fold predictions are the best prefix's
    own = fit.attach(rows, "pred", True).groupBy("fold").agg(F.avg((F.col("pred") - F.col("label")) ** 2).alias("e")).collect()
    assert {r.fold: pytest.approx(r.e, rel=1e-9) for r in own} == {f: min(fit.errors[f]) for f in range(K)}


def test_a_known_error_curve(spark):
    """Two groups of labels 0 and 1: each round of step 0.5 halves the distance to them."""
    rows = spark.createDataFrame([(i, i % 2, float(i // 2 % 2), float(i // 2 % 2)) for i in range(40)], "id long, fold int, a double, label double")
    prep = FoldPreprocessor(["a"], [], "tree", "fold", 2).fit(rows)
    fit = fit_boosted(rows, prep, BoostParams(rounds=4, step=0.5, depth=1, patience=None), "id", k=2)
    assert fit.errors[0] == pytest.approx([0.25 * 0.25 ** r for r in range(5)], rel=1e-6)


def test_the_fit_does_not_depend_on_partitions(rows, prep, monkeypatch):
    monkeypatch.setattr(boosting, "LEAST_ROWS", 100)
    p = BoostParams(rounds=3, depth=3, subsample=0.8, colsample=0.7, bagging_temperature=0.5, patience=None)
    a, b = (fit_boosted(rows.repartition(n), prep, p, "id", k=K) for n in (1, 7))
    assert a.trees == b.trees


def test_best_first_growth(rows, prep):
    full = fit_boosted(rows, prep, BoostParams(rounds=1, depth=6, patience=None), "id", k=K)
    small = fit_boosted(rows, prep, BoostParams(rounds=1, depth=6, leaves=20, patience=None), "id", k=K)
    for f in range(K):
        assert full.trees[f][0].n_leaves > 20 and small.trees[f][0].n_leaves == 20
        kept = sorted(small.trees[f][0].gain[i] for i, left in enumerate(small.trees[f][0].left) if left >= 0)
        assert kept[-1] == max(full.trees[f][0].gain)
    tree = Tree()
    a, b = tree.split(0, 0, 1, True, 10.0, (1.0, 2.0))
    tree.split(a, 0, 0, True, 1.0, (3.0, 4.0))
    tree.split(b, 0, 2, True, 5.0, (5.0, 6.0))
    assert tree.best_first(3).value == [0.0, 1.0, 2.0, 5.0, 6.0] and tree.best_first(1).left == [-1]


def test_symmetric_trees_and_absolute_loss(rows):
    prep = FoldPreprocessor(["a", "b"], ["c"], "native", "fold", K).fit(rows)
    fit = fit_boosted(rows, prep, BoostParams(rounds=25, step=0.2, depth=3, symmetric=True, loss="absolute", l2=1.0, patience=None), "id", k=K)
    for f in range(K):
        tree = fit.trees[f][0]
        level = {(tree.feature[i], tree.threshold[i]) for i in (tree.left[0], tree.right[0])}
        assert len(level) == 1 and fit.errors[f][-1] < 0.5 * fit.errors[f][0]


def test_odd_tables(spark, rows, prep):
    none = rows.where("1 = 0")
    empty = FoldPreprocessor(["a"], ["c"], "tree", "fold", K).fit(none)
    assert fit_boosted(none, empty, BoostParams(rounds=2), "id", k=K).attach(none, "p", True).count() == 0
    odd = rows.withColumn("label", F.when(F.col("id") % 5 > 0, F.col("label"))).withColumn("z", F.lit(None).cast("double"))
    prep_z = FoldPreprocessor(["a", "z"], ["c"], "tree", "fold", K).fit(odd)
    fit = fit_boosted(odd, prep_z, BoostParams(rounds=3, patience=None), "id", k=K)
    unseen = odd.withColumn("c", F.lit("never seen")).withColumn("a", F.lit(None).cast("double"))
    assert fit.attach(unseen, "p", False).where("p is null").count() == 0
    assert fit_boosted(rows, FoldPreprocessor([], [], "tree", "fold", K).fit(rows), BoostParams(), "id", k=K).attach(rows, "p", True).count() == 900


def test_one_scan_serves_all_models(rows, prep):
    boosted = ModelSpec("b", "tree", boost=BoostParams(rounds=3, patience=None))
    from foldline.operators.models import REGISTRY
    linear = FoldPreprocessor(["a", "b"], ["c"], "linear", "fold", K).fit(rows.withColumn("b", F.when(~F.isnan("b"), F.col("b"))))
    clean = rows.withColumn("b", F.when(~F.isnan("b"), F.col("b")))
    scorers = {"b": fit_folds(boosted, prep, clean, "id", k=K), "r": fit_folds(REGISTRY["Linear_Ridge"], linear, clean, "id", k=K)}
    wide = prediction_table(scorers, clean, ["id", "fold", "label"], True)
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("InMemoryTableScan")[0]
    long, mean = oof_predict(REGISTRY["Linear_Ridge"], linear, clean, clean.drop("label", "fold"), "id", k=K)
    assert {r.id: r.r for r in wide.collect()} == {r.id: pytest.approx(r.pred) for r in long.collect()}
    assert mean.count() == 900 and wide.where("b is null or r is null").count() == 0


def test_halving_beats_or_equals_the_same_budget_at_random(rows, prep):
    candidates = [{"maxDepth": d, "stepSize": s} for d, s in ((1, 0.02), (2, 0.05), (1, 0.3), (3, 0.4), (2, 0.01), (1, 0.1))]
    found = halving_search(rows, prep, candidates, "id", k=K, rounds=2, factor=3, log_scale=False)
    assert [r["rounds"] for r in found] == [2] * 6 + [6] * 2 + [18]
    budget = sum(r["rounds"] for r in found)
    plain = gbt_search(rows, prep, candidates[:2], "id", k=K, rounds=budget // 2, log_scale=False)
    assert found[-1]["cv_mae"] <= min(r["cv_mae"] for r in plain)


def test_ordered_target_stats_of_a_hot_category(spark):
    df = spark.createDataFrame([(i, "hot" if i % 3 else None, float(i) if i % 7 else None) for i in range(200)], "id long, c string, label double")
    got = {r.id: r.c_ots for r in ordered_target_stats(df, ["c"], "label", "id", num_partitions=9).collect()}
    import hashlib
    rows = sorted(((hashlib.md5(f"42:{i}".encode()).hexdigest(), i) for i in range(200)))
    grand = np.mean([float(i) for i in range(200) if i % 7])
    for cat in (True, False):
        s = n = 0
        for _, i in rows:
            if bool(i % 3) == cat:
                assert got[i] == pytest.approx((s + grand) / (n + 1))
                if i % 7:
                    s, n = s + i, n + 1
