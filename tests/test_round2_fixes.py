"""Faults found in review: each case fails without its fix."""

import pytest

from foldline.operators.impute import FillGroupMedian
from foldline.operators.metrics import metric_table
from foldline.operators.boosting import fit_binning
from foldline.operators.models import REGISTRY, FitContext
from foldline.operators.preprocess import FoldPreprocessor
from foldline.operators.stacking import label_context
from foldline.operators.tune import gbt_search


def test_group_median_of_whole_numbers_falls_between_two(spark):
    df = spark.createDataFrame([("a", 60), ("a", 61), ("a", None), ("b", None)], "k string, v int")
    filled = FillGroupMedian("v", "k").fit(df).transform(df)
    assert sorted(r.v for r in filled.where("k = 'a'").collect()) == [60.0, 60.5, 61.0]
    assert filled.where("k = 'b'").first().v == 60.5


def test_native_categories_keep_missing_apart_from_unseen(spark):
    df = spark.createDataFrame([(0, "x", 1.0), (0, None, 2.0), (1, "x", 1.0), (1, None, 3.0)], "fold int, c string, n double")
    model = FoldPreprocessor(["n"], ["c"], "native", "fold", 2).fit(df)
    new = spark.createDataFrame([(0, None, 1.0), (0, "zz", 1.0), (0, "x", 1.0)], "fold int, c string, n double")
    assert len({r["cat__c"] for r in model.transform(new, 0, ["fold"]).collect()}) == 3


def test_label_context_does_not_cancel(spark):
    df = spark.createDataFrame([(i % 2, 1e9 + i % 4) for i in range(40)], "fold int, label double")
    # fold 1 trains fold 0's model: labels 1e9 + 1 and 1e9 + 3
    assert [x for x in vars(label_context(df, "label", "fold", 2)[0]).values() if isinstance(x, float)][1] == pytest.approx(1.0)


def test_column_without_training_values_is_dropped(spark):
    df = spark.createDataFrame([(0, 1.0, None), (1, 2.0, None), (1, 4.0, None)], "fold int, a double, b double")
    model = FoldPreprocessor(["a", "b"], [], "tree", "fold", 2).fit(df)
    assert model.features(df, 0, ["fold"]).first().features.toArray().tolist() == [1.0]


def test_registry_has_the_full_settings():
    boosted = {name: REGISTRY[name].boost for name in ("XGBoost", "CatBoost", "LightGBM")}
    assert [(p.rounds, p.patience) for p in boosted.values()] == [(5000, 150), (6000, 100), (8000, 100)]
    forest = REGISTRY["ExtraTrees"].build(FitContext(100.0, 1.0), {})
    assert (forest.getNumTrees(), forest.getMaxDepth()) == (800, 20)


def test_gbt_search_uses_each_folds_own_statistics(spark):
    # the median of a fold's training rows fills its gap: fold 0 trains on fold 1 and the other way round
    rows = [(10 * f + i, f, None if i == 0 else float(i + 10 * f), float(i + 10 * f)) for f in range(2) for i in range(6)]
    df = spark.createDataFrame(rows, "id long, fold int, a double, label double")
    prep = FoldPreprocessor(["a"], [], "tree", "fold", 2).fit(df)
    binning = fit_binning(df, prep, "id", 2, 64)
    edge = lambda v: int(sum(e < v for e in binning.edges[0])) + 1
    assert binning.fills[:, 0].tolist() == [edge(13.0), edge(3.0)]
    candidates = [{"maxDepth": 1, "stepSize": 0.1}, {"maxDepth": 2, "stepSize": 0.3}]
    found = gbt_search(df, prep, candidates, k=2, rounds=1, log_scale=False)
    assert [{k: r[k] for k in c} for r, c in zip(found, candidates)] == candidates
    # labels 0..5 and 10..15: a model of one fold is about 10 off on the other
    assert all(5 < r["cv_mae"] < 15 for r in found)


def test_metrics_of_rows_without_prediction_are_null(spark):
    df = spark.createDataFrame([("m", 0, 1.0, None), ("m", 1, 2.0, 3.0)], "model string, fold int, label double, pred double")
    got = {r.fold: r.value for r in metric_table(df, log_scale=False).where("metric = 'mae'").collect()}
    assert got == {0: None, 1: 1.0, None: 1.0}
