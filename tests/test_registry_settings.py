"""Queries of base models that run at the registry's settings."""

import pytest


@pytest.mark.parametrize("name, model", [("gbt_mae_oof", "CatBoost"), ("gbt_small_leaf_oof", "LightGBM"), ("forest_oof", "ExtraTrees")])
def test_a_query_passes_no_smaller_settings(spark, sf_dir, monkeypatch, name, model):
    from foldline.operators import stacking
    from foldline.operators.models import REGISTRY
    from foldline.plans.catalog import QUERIES
    asked = []

    def seen(spec, prep, train, score, id_col, label, fold_col, k, params=None):
        asked.append((spec, params))
        return train.withColumn("pred", train.label), None
    monkeypatch.setattr(stacking, "oof_predict", seen)
    assert QUERIES[name](spark, sf_dir).count() > 0
    assert len(asked) == 1 and asked[0][0] is REGISTRY[model] and not asked[0][1]
