"""Hand-made edge rows (NULL, unseen, ties, zero denominators, boundaries)."""

import math

import pytest
from pyspark.sql import functions as F

from foldline.functions import columns as C
from foldline.operators import encode, features, impute, quantiles
from foldline.operators.metrics import EPS, pct_error
from foldline.operators.skew import SkewCorrector
from foldline.plans import housing


def rows(df, col, order="i"):
    return [r[col] for r in df.orderBy(order).collect()]


def test_outlier_delete_keeps_null_rows(spark):
    df = spark.createDataFrame(
        [(0, 4001, 299999.0), (1, 4000, 1.0), (2, 5000, 300000.0), (3, 5000, None), (4, None, 1.0)],
        "i int, GrLivArea int, SalePrice double")
    out = impute.remove_outliers(df, housing.outlier_rule(df))
    assert rows(out, "i") == [1, 2, 3, 4]
    assert impute.count_outliers(df, housing.outlier_rule(df)).first()[0] == 1


def test_mode_fill_tie_goes_to_smallest(spark):
    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, "b"), (3, "a"), (4, None)], "i int, c string")
    assert rows(impute.fill_mode(df, ["c"]), "c") == ["b", "a", "b", "a", "a"]


def test_group_median_fill_semantics(spark):
    df = spark.createDataFrame(
        [(0, "a", 1.0), (1, "a", 2.0), (2, "a", None), (3, "a", None), (4, "c", 30.0),
         (5, None, 7.0), (6, None, None), (7, "b", None)], "i int, k string, v double")
    out = rows(impute.fill_group_median(df, "v", "k"), "v")
    # a -> 1.5; NULL-key rows lose their value and, like b, get the global
    # median of the group-filled column (1, 1.5, 1.5, 2, 30) = 1.5
    assert out == [1.0, 2.0, 1.5, 1.5, 30.0, 1.5, 1.5, 1.5]


def test_exact_median_matches_numpy_on_skewed_groups(spark):
    import numpy as np
    rng = np.random.default_rng(7)
    data = [(("hot" if rng.random() < 0.6 else f"g{rng.integers(5)}"), float(rng.normal()))
            for _ in range(3000)]
    df = spark.createDataFrame(data, "k string, v double")
    got = {r["k"]: r["median"] for r in quantiles.grouped_median(df, ["k"], "v").collect()}
    for k in got:
        exp = float(np.median([v for g, v in data if g == k]))
        assert math.isclose(got[k], exp, rel_tol=0, abs_tol=1e-12)


def test_ordinal_map_defaults(spark):
    df = spark.createDataFrame([(0, "Ex", "Ex", "Gtl"), (1, "Po", "zz", "zz"), (2, "zz", None, None),
                                (3, None, "Typ", "Sev")], "i int, q string, Functional string, LandSlope string")
    out = encode.OrdinalMap(["q"], housing.QUALITY_MAP, 0).transform(df)
    out = encode.OrdinalMap(["Functional"], housing.FUNCTIONAL_MAP, 8).transform(out)
    out = encode.OrdinalMap(["LandSlope"], housing.LAND_SLOPE_MAP, 2).transform(out)
    assert rows(out, "q") == [5, 1, 0, 0]
    assert rows(out, "Functional") == [8, 8, 8, 8]
    assert rows(out, "LandSlope") == [2, 2, 2, 0]


def test_flag_equals(spark):
    df = spark.createDataFrame([(0, "Y"), (1, "N"), (2, None)], "i int, CentralAir string")
    assert rows(encode.flag_equals(df, "CentralAir", "Y"), "CentralAir") == [1, 0, 0]


def test_age_clamp_and_ratio_guard(spark):
    df = spark.createDataFrame([(0, 2010, 2000, 5.0, 0.0), (1, 2007, 2008, 5.0, None),
                                (2, 2010, None, None, 2.0), (3, 2010, 2010, 4.0, 8.0)],
                               "i int, y int, b int, n double, d double")
    out = df.select("i", C.clamp_min(F.col("y") - F.col("b")).alias("age"),
                    C.guarded_ratio("n", "d").alias("r"))
    assert rows(out, "age") == [10, 0, 0, 0]
    assert rows(out, "r") == [5.0, 5.0, 0.0, 0.5]


def test_not_equal_flag(spark):
    df = spark.createDataFrame([(0, 1, 1), (1, 1, 2), (2, 1, None), (3, None, None)], "i int, a int, b int")
    assert rows(df.select("i", C.not_equal_flag("a", "b").alias("f")), "f") == [0, 1, 1, 1]


def test_age_bins_are_right_closed(spark):
    ages = [0, 5, 6, 15, 16, 30, 50, 51, 200, 201, None]
    df = spark.createDataFrame(list(enumerate(ages)), "i int, Age int")
    out = df.select("i", C.right_closed_bins("Age", features.AGE_BIN_EDGES, features.AGE_BIN_LABELS).alias("b"))
    assert rows(out, "b") == [4.0, 4.0, 3.0, 3.0, 2.0, 2.0, 1.0, 0.0, 0.0, 0.0, 0.0]


def test_season_and_kitchen_value(spark):
    df = spark.createDataFrame([(0, 2), (1, 3), (2, 6), (3, 7), (4, None)], "i int, m int")
    assert rows(df.select("i", C.member_flag("m", [3, 4, 5, 6]).alias("s")), "s") == [0, 1, 1, 0, 0]
    k = spark.createDataFrame([(0, 3, None), (1, 3, 2)], "i int, KitchenQual int, KitchenAbvGr int")
    assert rows(k.select("i", (F.col("KitchenQual") * C.nz("KitchenAbvGr", 1)).alias("v")), "v") == [3, 6]


def test_skew_selection(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    n = 400
    expo = rng.exponential(size=n)
    data = [(1.0, float(expo[j] - 0.5), float(expo[j]), float(rng.normal())) for j in range(n)]
    df = spark.createDataFrame(data, "const double, neg double, pos double, sym double")
    model = SkewCorrector(0.75).fit(df)
    assert model.columns == ["pos"]


def test_target_encoding_unseen_and_null(spark):
    df = spark.createDataFrame(
        [(0, "a", 0, 1.0), (1, "a", 1, 3.0), (2, "only0", 0, 10.0), (3, None, 1, 5.0), (4, "a", 2, 2.0)],
        "i int, c string, fold int, y double")
    model = encode.TargetEncoder("c", "y").fit(df)
    out = {r["i"]: r["c_te"] for r in model.transform_train(df).collect()}
    gmean = (1 + 3 + 10 + 5 + 2) / 5
    assert out[0] == pytest.approx(2.5) and out[1] == pytest.approx(1.5)
    assert out[2] == pytest.approx(gmean) and out[3] == pytest.approx(gmean)
    score = spark.createDataFrame([(9, "zz"), (8, "a")], "i int, c string")
    sc = {r["i"]: r["c_te"] for r in model.transform_score(score).collect()}
    assert sc[9] == pytest.approx(gmean) and sc[8] == pytest.approx(2.0)


def test_mape_zero_label_has_no_division_error(spark):
    df = spark.createDataFrame([(0.0, 1.0)], "y double, p double")
    v = df.select(pct_error(F.col("y"), F.col("p"), log_scale=False).alias("e")).first()["e"]
    assert v == pytest.approx(1.0 / EPS)


def test_registry_skips_unknown(caplog):
    from foldline.operators.models import resolve
    specs = resolve(["Linear_Ridge", "NoSuchModel"])
    assert [s.name for s in specs] == ["Linear_Ridge"]


def test_schema_guard_skips_missing_columns(spark):
    df = spark.createDataFrame([(1, None)], "Id int, Alley string")
    out = impute.fill_constant(df, housing.NONE_FILL_COLUMNS, "None")
    assert out.columns == ["Id", "Alley"] and out.first()["Alley"] == "None"


def test_skew_with_no_numeric_columns(spark):
    df = spark.createDataFrame([("a",), ("b",)], "s string")
    model = SkewCorrector(0.75).fit(df)
    assert model.columns == [] and model.transform(df).count() == 2


def test_target_encoding_ignores_missing_labels(spark):
    df = spark.createDataFrame([(0, "a", 0, 1.0), (1, "a", 1, None), (2, "a", 1, 3.0), (3, "b", 0, 5.0)],
                               "i int, c string, fold int, y double")
    out, _ = encode.target_encode(df, None, ["c"], "y")
    got = {r["i"]: r["c_te"] for r in out.collect()}
    assert got[0] == pytest.approx(3.0) and got[1] == pytest.approx(1.0)
    m = encode.TargetEncoder("c", "y").fit(df)
    assert m.global_mean == pytest.approx(3.0)


def test_target_encoding_category_without_labels(spark):
    df = spark.createDataFrame([(0, "a", 0, 1.0), (1, "z", 1, None), (2, "a", 1, 3.0)],
                               "i int, c string, fold int, y double")
    model = encode.TargetEncoder("c", "y").fit(df)
    score = spark.createDataFrame([(9, "z")], "i int, c string")
    assert model.transform_score(score).first()["c_te"] == pytest.approx(2.0)
