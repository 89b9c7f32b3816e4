"""Registered queries: one per operator of the inventory.

Each query is ``(spark, sf_dir) -> DataFrame`` over the whole driver tables
(or the housing-shaped stand-in derived from them) and returns aliased,
rounded columns so that it can be compared with ``foldline.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldline.functions.columns import numeric_columns
from foldline.functions.hashing import bucket
from foldline.operators import encode, features, folds, impute, quantiles
from foldline.plans import housing
from foldline.session import cut_lineage, stored
from foldline.sources.standin import housing_standin
from foldline.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SEED = 42
K = 5


def query(fn):
    QUERIES[fn.__name__.removeprefix("q_")] = fn
    return fn


def r6(c):
    """Round half up to 6 decimals with the same IEEE steps as the SQL side."""
    x = F.col(c) if isinstance(c, str) else c
    return F.floor(x * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)


def r2(c):
    """Money: round half up to cents (same IEEE steps as the SQL side)."""
    x = F.col(c) if isinstance(c, str) else c
    return F.floor(x * F.lit(100.0) + F.lit(0.5)) / F.lit(100.0)


# ---------------------------------------------------------------- inputs
def standin(spark, sf_dir) -> DataFrame:
    return housing_standin(spark, sf_dir)


def encoded(spark, sf_dir) -> DataFrame:
    """Stand-in after the ordinal step only (no fills)."""
    return housing.encode_ordinals(standin(spark, sf_dir))


def featured(spark, sf_dir) -> DataFrame:
    return features.add_advanced_features(features.add_features(encoded(spark, sf_dir)))


def order_target(spark, sf_dir) -> DataFrame:
    """orders with the log target, a hash fold and a category with gaps."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus",
                                              "o_totalprice")
    return (o.withColumn("label", F.log1p("o_totalprice"))
            .withColumn("o_orderpriority", F.when(bucket("o_orderkey", "prio_mask", 20) > 0,
                                                  F.col("o_orderpriority")))
            .transform(lambda d: folds.hash_fold(d, "o_orderkey", K, SEED)))


def is_scoring(key: str):
    """Hold-out split: every row lands on exactly one side."""
    return bucket(F.col(key), "holdout", 10) == 0


# ---------------------------------------------------------------- cleaning
@query
def q_fill_const(spark, sf_dir):
    df = impute.fill_constant(standin(spark, sf_dir), housing.NONE_FILL_COLUMNS, "None")
    df = impute.fill_constant(df, ["Functional"], housing.FUNCTIONAL_DEFAULT)
    return df.select("Id", *housing.NONE_FILL_COLUMNS, "Functional")


@query
def q_fill_zero(spark, sf_dir):
    df = impute.fill_constant(standin(spark, sf_dir), housing.ZERO_FILL_COLUMNS, 0)
    return df.select("Id", *housing.ZERO_FILL_COLUMNS)


@query
def q_fill_mode(spark, sf_dir):
    df = impute.fill_mode(standin(spark, sf_dir), housing.MODE_FILL_COLUMNS)
    return df.select("Id", *housing.MODE_FILL_COLUMNS)


@query
def q_mode_smallest(spark, sf_dir):
    df = standin(spark, sf_dir)
    counts = impute.stacked_counts(df, housing.MODE_FILL_COLUMNS)
    return quantiles.mode_from_counts(counts, ["name"], "value").select(
        F.col("name").alias("column"), F.col("mode"))


@query
def q_fill_group_median(spark, sf_dir):
    df = impute.fill_group_median(standin(spark, sf_dir), "LotFrontage", "Neighborhood")
    return df.select("Id", "Neighborhood", r6("LotFrontage").alias("LotFrontage"))


@query
def q_group_median(spark, sf_dir):
    med = quantiles.grouped_median(standin(spark, sf_dir), ["Neighborhood"], "LotFrontage")
    return med.select("Neighborhood", r6("median").alias("median_lot_frontage"))


@query
def q_cast_code(spark, sf_dir):
    return impute.cast_to_string(standin(spark, sf_dir), housing.CODE_AS_STRING) \
        .select("Id", "MSSubClass")


@query
def q_drop_outliers(spark, sf_dir):
    df = standin(spark, sf_dir)
    return impute.remove_outliers(df, housing.outlier_rule(df)).select("Id", "GrLivArea",
                                                                      "SalePrice")


@query
def q_outlier_count(spark, sf_dir):
    df = standin(spark, sf_dir)
    return impute.count_outliers(df, housing.outlier_rule(df))


@query
def q_clean_data(spark, sf_dir):
    df = housing.clean_data(standin(spark, sf_dir))
    return df.select("Id", "MSZoning", "KitchenQual", "SaleType", "Functional", "PoolQC",
                     "GarageYrBlt", "MSSubClass", r6("LotFrontage").alias("LotFrontage"))


# ---------------------------------------------------------------- encodings
ORDINAL_OUT = housing.QUALITY_COLUMNS + ["BsmtExposure", "BsmtFinType1", "BsmtFinType2",
                                         "GarageFinish", "Fence", "Functional", "PavedDrive",
                                         "CentralAir", "LotShape", "LandSlope"]


@query
def q_ordinal_encode(spark, sf_dir):
    return encoded(spark, sf_dir).select("Id", *ORDINAL_OUT)


@query
def q_ordinal_default(spark, sf_dir):
    df = standin(spark, sf_dir)
    out = encode.OrdinalMap(["Functional"], housing.FUNCTIONAL_MAP, 8).transform(df)
    out = encode.OrdinalMap(["LandSlope"], housing.LAND_SLOPE_MAP, 2).transform(out)
    return out.select("Id", "Functional", "LandSlope")


@query
def q_flag_equals(spark, sf_dir):
    return encode.flag_equals(standin(spark, sf_dir), "CentralAir", "Y").select("Id", "CentralAir")


@query
def q_tier_lookup(spark, sf_dir):
    return housing.add_spatial_clusters(standin(spark, sf_dir)).select(
        "Id", "Neighborhood", "Neighborhood_Clustered")


# ---------------------------------------------------------------- features
BASIC = ["TotalSF", "TotalBath", "Age", "RemodAge", "TotalPorchSF", "HasPool", "HasGarage",
         "HasBasement", "HasFireplace", "QualSF", "QualFinishSF", "OverallScore",
         "GarageInteraction", "BsmtFinRatio", "LivAreaRatio", "TotalOutdoorSF", "BsmtScore",
         "GarageScore", "ExterScore"]
ADVANCED = features.ADVANCED_FEATURES
FEATURE_GROUPS = {
    "feat_sum": ["TotalSF", "TotalBath", "TotalPorchSF", "TotalOutdoorSF"],
    "feat_age": ["Age", "RemodAge"],
    "feat_flags": ["HasPool", "HasGarage", "HasBasement", "HasFireplace", "Has2ndFloor"],
    "feat_product": ["QualSF", "QualFinishSF", "OverallScore", "GarageInteraction", "BsmtScore",
                     "GarageScore", "ExterScore", "KitchenValue", "GarageValue", "OverallGrade"],
    "feat_ratio": ["BsmtFinRatio", "LivAreaRatio", "BathPerSF", "FinishedBsmtRatio"],
    "feat_not_equal": ["HasBeenRemodeled"],
    "feat_rowsum_dynamic": ["TotalQualScore"],
    "feat_season": ["SeasonSold"],
    "feat_bin": ["AgeBin"],
}


def _rounded(df: DataFrame, cols) -> list:
    out = []
    for c in cols:
        t = df.schema[c].dataType.typeName()
        out.append(r6(c).alias(c) if t in ("double", "float") else F.col(c))
    return out


@query
def q_features_basic(spark, sf_dir):
    df = features.add_features(encoded(spark, sf_dir))
    return df.select("Id", *_rounded(df, BASIC))


@query
def q_features_advanced(spark, sf_dir):
    df = featured(spark, sf_dir)
    return df.select("Id", *_rounded(df, ADVANCED))


def _feature_group(name):
    def run(spark, sf_dir):
        df = featured(spark, sf_dir)
        return df.select("Id", *_rounded(df, FEATURE_GROUPS[name]))
    run.__name__ = f"q_{name}"
    run.__doc__ = f"Feature columns {FEATURE_GROUPS[name]} on the encoded stand-in."
    return run


for _name in FEATURE_GROUPS:
    query(_feature_group(_name))


@query
def q_feat_square(spark, sf_dir):
    df = features.add_poly_features(features.add_features(encoded(spark, sf_dir)))
    cols = [f"{c}_sq" for c in features.SQUARE_COLUMNS] + ["TotalSF_x_OverallQual"]
    return df.select("Id", *_rounded(df, cols))


@query
def q_recipe_chain(spark, sf_dir):
    """The active recipe (clean, ordinals, features, domain features) in order."""
    from foldline.plans.recipe import run_steps
    df = run_steps(standin(spark, sf_dir), housing.Recipe().steps)
    cols = ["LotFrontage", "MSZoning", "KitchenQual", "Functional", "MSSubClass", "TotalSF",
            "TotalBath", "Age", "QualSF", "BsmtScore", "BathPerSF", "KitchenValue",
            "TotalQualScore", "AgeBin", "FinishedBsmtRatio"]
    return df.select("Id", *_rounded(df, cols))


@query
def q_select_numeric(spark, sf_dir):
    """Projection on the numeric columns chosen from the schema."""
    df = standin(spark, sf_dir)
    return df.select(*_rounded(df, numeric_columns(df.schema)))


@query
def q_drop_tolerant(spark, sf_dir):
    """Drop list applied as is; names absent from the table are ignored."""
    df = standin(spark, sf_dir).drop(*housing.DROP_FEATURES)
    return df.select(*_rounded(df, df.columns))


@query
def q_head_n(spark, sf_dir):
    """First rows by id: the schema sample of the tuning script."""
    df = standin(spark, sf_dir)
    return df.orderBy("Id").limit(2).select("Id", "Neighborhood", "GrLivArea", "SalePrice")


# ---------------------------------------------------------------- folds, target encoding
@query
def q_kfold_assign(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    return folds.hash_fold(o, "o_orderkey", K, SEED)


@query
def q_kfold_balanced(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    return folds.balanced_fold(o, "o_orderkey", K, SEED)


@query
def q_target_encode_oof(spark, sf_dir):
    df = order_target(spark, sf_dir)
    model = encode.TargetEncoder("o_orderpriority", "label").fit(df)
    return model.transform_train(df).select("o_orderkey", "fold",
                                            r6("o_orderpriority_te").alias("o_orderpriority_te"))


@query
def q_target_encode_full(spark, sf_dir):
    df = order_target(spark, sf_dir)
    train, score = df.where(~is_scoring("o_orderkey")), df.where(is_scoring("o_orderkey"))
    model = encode.TargetEncoder("o_orderpriority", "label").fit(train)
    return model.transform_score(score).select(
        "o_orderkey", r6("o_orderpriority_te").alias("o_orderpriority_te"))


@query
def q_target_encode_multi(spark, sf_dir):
    df = folds.hash_fold(standin(spark, sf_dir), "Id", K, SEED).withColumn(
        "label", F.log1p("SalePrice"))
    out, _ = encode.target_encode(df, None, housing.TARGET_ENCODE_COLUMNS, "label")
    return out.select("Id", *[r6(f"{c}_te").alias(f"{c}_te") for c in housing.TARGET_ENCODE_COLUMNS])


@query
def q_global_mean(spark, sf_dir):
    return order_target(spark, sf_dir).agg(r6(F.avg("label")).alias("mean_label"))


@query
def q_group_mean(spark, sf_dir):
    return order_target(spark, sf_dir).groupBy("o_orderstatus").agg(
        r6(F.avg("label")).alias("mean_label"), F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- linear stacking on the order frame
RIDGE_ALPHA, META_ALPHA = 10.0, 1.0
BASE_FEATURES = ["x_qty", "x_disc"]
BLEND_WEIGHTS = [0.9, 0.8, 0.7, 0.6]
TUNE_ALPHAS = [1e-4, 1e-3, 1e-2, 1e-1, 1.0]


def model_frame(spark, sf_dir) -> DataFrame:
    """Order frame as a regression table: log target, two imputed features,
    a gappy category, a hash fold and the hold-out flag."""
    from foldline.sources.tables import order_frame
    of = order_frame(spark, sf_dir)
    df = of.select(
        "o_orderkey", F.log1p("o_totalprice").alias("label"),
        F.coalesce("qty", F.lit(0.0)).alias("x_qty"),
        (F.coalesce("disc", F.lit(0.0)) * F.lit(100.0)).alias("x_disc"),
        F.when(bucket("o_orderkey", "prio_mask", 20) > 0, F.col("o_orderpriority")).alias("prio"),
        is_scoring("o_orderkey").alias("scoring"))
    return folds.hash_fold(df, "o_orderkey", K, SEED)


def _ridge_oof(train: DataFrame, feats, alpha=RIDGE_ALPHA):
    from foldline.operators import linear
    fs = linear.fold_stats(train, feats, "label", "fold")
    fits = {f: linear.ridge_fit(fs, fs.train(f), alpha) for f in fs.per_fold}
    return fits, train.withColumn("pred", linear.fold_case("fold", fits, feats))


def _stack_inputs(spark, sf_dir):
    """Training rows with two closed-form base predictions (ridge, OOF target
    encoding) and the scoring rows with their fold-mean / full-data versions."""
    from foldline.operators import linear
    # seven narrow columns read by ~8 statistics passes: materialise once
    mf = cut_lineage(model_frame(spark, sf_dir))
    train, score = mf.where(~F.col("scoring")), mf.where(F.col("scoring"))
    fits, scored = _ridge_oof(train, BASE_FEATURES)
    te = encode.TargetEncoder("prio", "label", out_col="te").fit(train)
    train_p = te.transform_train(scored.withColumnRenamed("pred", "ridge"))
    mean_fit = linear.mean_model(list(fits.values()))
    score_p = te.transform_score(score.withColumn("ridge", mean_fit.predict(BASE_FEATURES)))
    return cut_lineage(train_p), cut_lineage(score_p)


@query
def q_ridge_oof(spark, sf_dir):
    train = model_frame(spark, sf_dir).where(~F.col("scoring"))
    _, out = _ridge_oof(train, BASE_FEATURES)
    return out.select("o_orderkey", "fold", r6("pred").alias("pred"))


def _long_preds(spark, sf_dir):
    train_p, _ = _stack_inputs(spark, sf_dir)
    return train_p.select("o_orderkey", "fold", "label", F.inline(F.array(
        F.struct(F.lit("ridge").alias("model"), F.col("ridge").alias("pred")),
        F.struct(F.lit("te").alias("model"), F.col("te").alias("pred")))))


@query
def q_metric_table(spark, sf_dir):
    from foldline.operators.metrics import metric_table
    mt = metric_table(_long_preds(spark, sf_dir))
    return mt.select("model", "fold", "metric", r6("value").alias("value"))


@query
def q_mae_by_fold(spark, sf_dir):
    return _ridge_metric(spark, sf_dir, "mae")


@query
def q_mape(spark, sf_dir):
    return _ridge_metric(spark, sf_dir, "mape")


def _ridge_metric(spark, sf_dir, metric):
    from foldline.operators.metrics import metric_table
    train = model_frame(spark, sf_dir).where(~F.col("scoring"))
    _, out = _ridge_oof(train, BASE_FEATURES)
    mt = metric_table(out.select(F.lit("ridge").alias("model"), "fold", "label", "pred"))
    return mt.where(F.col("metric") == metric).select("fold", r6("value").alias(metric))


@query
def q_cv_summary(spark, sf_dir):
    from foldline.operators.metrics import cv_summary, metric_table
    s = cv_summary(metric_table(_long_preds(spark, sf_dir)))
    return s.select("model", r6("mae_mean").alias("mae_mean"), r6("mae_std").alias("mae_std"),
                    "n_folds")


@query
def q_meta_matrix(spark, sf_dir):
    from foldline.operators.stacking import meta_matrix
    wide = meta_matrix(_long_preds(spark, sf_dir), "o_orderkey", ["ridge", "te"])
    return wide.select("o_orderkey", "fold", r6("label").alias("label"), r6("ridge").alias("ridge"),
                       r6("te").alias("te"))


def _meta_fit(train_p):
    from foldline.operators import linear
    fs = linear.fold_stats(train_p, ["ridge", "te"], "label", None)
    return linear.ridge_fit(fs, fs.per_fold[0], META_ALPHA)


@query
def q_meta_ridge(spark, sf_dir):
    """Meta Ridge(1.0) coefficients on the prediction table (4 decimals, as reported)."""
    train_p, _ = _stack_inputs(spark, sf_dir)
    fit = _meta_fit(train_p)
    terms = [("ridge", float(fit.coef[0])), ("te", float(fit.coef[1])),
             ("intercept", float(fit.intercept))]
    coefs = spark.createDataFrame(terms, "term string, coef double")
    return coefs.select("term", (F.floor(F.col("coef") * 1e4 + 0.5) / 1e4).alias("coef"))


@query
def q_blend_sweep(spark, sf_dir):
    from foldline.operators.metrics import blend_sweep
    train_p, _ = _stack_inputs(spark, sf_dir)
    out = blend_sweep(train_p, "label", "ridge", "te", BLEND_WEIGHTS)
    return out.select(r6("weight").alias("weight"), r6("mae").alias("mae"))


@query
def q_best_candidate(spark, sf_dir):
    """Lowest MAE among the base models and the blends; ties go to the
    earlier candidate in priority order (ridge first)."""
    from foldline.operators.metrics import abs_error, blend_sweep
    train_p, _ = _stack_inputs(spark, sf_dir)
    y = F.col("label")
    base = train_p.agg(F.avg(abs_error(y, F.col("ridge"))).alias("ridge"),
                       F.avg(abs_error(y, F.col("te"))).alias("te")).select(F.inline(F.array(
                           F.struct(F.lit("ridge").alias("candidate"), F.col("ridge").alias("mae"),
                                    F.lit(0).alias("priority")),
                           F.struct(F.lit("te").alias("candidate"), F.col("te").alias("mae"),
                                    F.lit(1).alias("priority")))))
    order = F.array(*[F.lit(float(w)) for w in BLEND_WEIGHTS])
    blends = blend_sweep(train_p, "label", "ridge", "te", BLEND_WEIGHTS).select(
        F.concat(F.lit("blend_"), F.col("weight").cast("string")).alias("candidate"), "mae",
        (F.array_position(order, F.col("weight")) + 1).cast("int").alias("priority"))
    allc = base.unionByName(blends)
    best = allc.agg(F.min_by(F.struct("candidate", "mae"), F.struct("mae", "priority")).alias("b"))
    return best.select("b.candidate", r6("b.mae").alias("mae"))


@query
def q_fold_mean_pred(spark, sf_dir):
    _, score_p = _stack_inputs(spark, sf_dir)
    return score_p.select("o_orderkey", r6("ridge").alias("pred"))


def _scratch(spark, name):
    import uuid
    from foldline.session import ensure_checkpoint_dir
    return ensure_checkpoint_dir(spark).rstrip("/") + f"/{name}-{uuid.uuid4().hex}"


@query
def q_submission_frame(spark, sf_dir):
    """The submission file of the better meta model, written and read back (money rounded to cents)."""
    from foldline.operators.stacking import evaluate_meta
    from foldline.sources.csv import write_submission
    train_p, score_p = _stack_inputs(spark, sf_dir)
    final = evaluate_meta(train_p, ["ridge", "te"], "label", score_p, "o_orderkey").final_pred
    path = _scratch(spark, "submission")
    write_submission(final.select("o_orderkey", r2("pred").alias("pred")), path, "o_orderkey", "pred")
    return spark.read.option("header", True).schema("Id long, SalePrice double").csv(path)


LINEAR_NUMERIC = ["n_lines", "x_disc"]


def _linear_folds(spark, sf_dir, name):
    """Train and score rows and the fold models of one registry model on two imputed, standardised columns."""
    from foldline.operators.models import REGISTRY
    from foldline.operators.preprocess import FoldPreprocessor
    from foldline.operators.stacking import fit_folds
    train, score = model_tables(spark, sf_dir)
    prep = FoldPreprocessor(LINEAR_NUMERIC, [], "linear", "fold", K).fit(train)
    return train, score, fit_folds(REGISTRY[name], prep, train, "o_orderkey", "label", "fold", K)


@query
def q_linear_ridge_two(spark, sf_dir):
    """Out-of-fold predictions of the registry's ridge on two columns."""
    train, _, model = _linear_folds(spark, sf_dir, "Linear_Ridge")
    return model.attach(train, "pred", True).select("o_orderkey", "fold", r6("pred").alias("pred"))


@query
def q_lasso_two(spark, sf_dir):
    """Out-of-fold predictions of the registry's lasso on two columns."""
    train, _, model = _linear_folds(spark, sf_dir, "Linear_Lasso")
    return model.attach(train, "pred", True).select("o_orderkey", "fold", r6("pred").alias("pred"))


@query
def q_oof_score_mean(spark, sf_dir):
    """The scoring table by the mean of the registry ridge's fold models."""
    _, score, model = _linear_folds(spark, sf_dir, "Linear_Ridge")
    return model.attach(score, "pred", False).select("o_orderkey", r6("pred").alias("pred"))


@query
def q_oof_coverage(spark, sf_dir):
    """Every training id is predicted exactly once, in its own fold, by each of two registry models."""
    from foldline.operators.models import resolve
    from foldline.operators.preprocess import FoldPreprocessor
    from foldline.operators.stacking import fit_folds, long_predictions, prediction_table
    train, _ = model_tables(spark, sf_dir)
    prep = FoldPreprocessor(MODEL_NUMERIC, MODEL_CATEGORICAL, "linear", "fold", K).fit(train)
    scorers = {s.name: fit_folds(s, prep, train, "o_orderkey", "label", "fold", K) for s in resolve(["Linear_Ridge", "no such model", "Linear_Lasso"])}
    wide = prediction_table(scorers, train, ["o_orderkey", "fold"], True)
    long = long_predictions(wide, list(scorers), ["o_orderkey", "fold"])
    return long.groupBy("o_orderkey", "fold", "model").agg(F.count("pred").alias("n_preds"))


@query
def q_tune_grid(spark, sf_dir):
    """Cross-validated meta search, ridge sub-grid (l1_ratio = 0)."""
    from foldline.operators.tune import elastic_net_search
    train_p, _ = _stack_inputs(spark, sf_dir)
    res = elastic_net_search(train_p, ["ridge", "te"], [(a, 0.0) for a in TUNE_ALPHAS])
    return res.select("alpha", "l1_ratio", r6("mae").alias("mae"))


@query
def q_tune_best(spark, sf_dir):
    from foldline.operators.tune import best_trial, elastic_net_search
    train_p, _ = _stack_inputs(spark, sf_dir)
    res = elastic_net_search(train_p, ["ridge", "te"], [(a, 0.0) for a in TUNE_ALPHAS])
    return best_trial(res).select("alpha", "l1_ratio", r6("mae").alias("mae"))


@query
def q_ablation_delta(spark, sf_dir):
    """CV MAE of the ridge base model with and without the discount feature."""
    from foldline.operators.linear import fold_case
    from foldline.operators.metrics import abs_error
    train = model_frame(spark, sf_dir).where(~F.col("scoring"))
    full, _ = _ridge_oof(train, BASE_FEATURES)
    less, _ = _ridge_oof(train, ["x_qty"])
    y = F.col("label")
    m = train.select("label", fold_case("fold", full, BASE_FEATURES).alias("p_full"),
                     fold_case("fold", less, ["x_qty"]).alias("p_less"))
    agg = m.agg(F.avg(abs_error(y, F.col("p_full"))).alias("full"),
                F.avg(abs_error(y, F.col("p_less"))).alias("without_x_disc"))
    return agg.select(F.inline(F.array(
        F.struct(F.lit("full").alias("variant"), F.col("full").alias("mae"), F.lit(0.0).alias("delta")),
        F.struct(F.lit("without_x_disc").alias("variant"), F.col("without_x_disc").alias("mae"),
                 (F.col("without_x_disc") - F.col("full")).alias("delta"))))).select(
        "variant", r6("mae").alias("mae"), r6("delta").alias("delta"))


# ---------------------------------------------------------------- skew, scaling, per-fold preprocessing
PREP_NUMERIC = ["LotFrontage", "MasVnrArea", "GarageArea", "TotalBsmtSF", "GarageYrBlt"]
PREP_CATEGORICAL = ["MSZoning", "KitchenQual", "GarageType", "Electrical"]
STANDARDIZE_COLUMNS = ["LotFrontage", "GrLivArea", "TotalBsmtSF", "OverallQual"]


def skew_input(spark, sf_dir) -> DataFrame:
    return standin(spark, sf_dir).drop("SalePrice")


@query
def q_skewness_all(spark, sf_dir):
    from foldline.operators.skew import skew_stats
    df = skew_input(spark, sf_dir)
    st = skew_stats(df, numeric_columns(df.schema, exclude=["Id"]))
    return st.select("column", r6("skewness").alias("skewness"), "non_negative")


@query
def q_skew_select(spark, sf_dir):
    from foldline.operators.skew import SkewCorrector
    return SkewCorrector(0.75, exclude=["Id"]).selected(skew_input(spark, sf_dir)).select("column")


@query
def q_skew_apply(spark, sf_dir):
    from foldline.operators.skew import fix_skewness
    df = skew_input(spark, sf_dir)
    out, _ = fix_skewness(df, threshold=0.75, exclude=["Id"])
    cols = numeric_columns(df.schema, exclude=["Id"])
    return out.select("Id", *[r6(F.col(c).cast("double")).alias(c) for c in cols])


@query
def q_log_target(spark, sf_dir):
    return standin(spark, sf_dir).select("Id", r6(F.log1p("SalePrice")).alias("label"))


@query
def q_roundtrip_log(spark, sf_dir):
    return standin(spark, sf_dir).select(
        "Id", r2(F.expm1(F.log1p("SalePrice"))).alias("SalePrice"))


@query
def q_standardize(spark, sf_dir):
    from foldline.operators.scale import Standardizer
    df = standin(spark, sf_dir)
    out = Standardizer(STANDARDIZE_COLUMNS).fit(df).transform(df)
    return out.select("Id", *[r6(c).alias(c) for c in STANDARDIZE_COLUMNS])


def folded_standin(spark, sf_dir) -> DataFrame:
    return folds.hash_fold(standin(spark, sf_dir), "Id", K, SEED)


@query
def q_impute_median_fold(spark, sf_dir):
    """The median of each numeric column over the rows of the other folds."""
    from foldline.operators.preprocess import fold_medians
    med = fold_medians(folded_standin(spark, sf_dir), PREP_NUMERIC, "fold", K)
    return spark.createDataFrame([(f, c, m) for (f, c), m in med.items()], "fold int, column string, median double").select("fold", "column", r6("median").alias("median"))


@query
def q_impute_mode_fold(spark, sf_dir):
    """The most frequent value of each category over the rows of the other folds, ties to the smallest."""
    from foldline.operators.preprocess import fold_modes
    modes = fold_modes(folded_standin(spark, sf_dir), PREP_CATEGORICAL, "fold", K)
    return spark.createDataFrame([(f, c, m) for (f, c), m in modes.items()], "fold int, column string, mode string")


def _held_out(df, cols_fn):
    """Each row transformed by the preprocessor of its own held-out fold."""
    out = {}
    for f in range(K):
        for name, expr in cols_fn(f).items():
            out[name] = (F.when(F.col("fold") == F.lit(f), expr) if name not in out
                         else out[name].when(F.col("fold") == F.lit(f), expr))
    return df.select("Id", "fold", *[e.alias(n) for n, e in out.items()])


@query
def q_preprocess_tree(spark, sf_dir):
    """Tree preprocessor: per-fold median impute of numerics and mode impute of
    categories, applied to each row with the statistics of its held-out fold."""
    from foldline.operators.preprocess import FoldPreprocessor
    df = folded_standin(spark, sf_dir)
    prep = FoldPreprocessor(PREP_NUMERIC, PREP_CATEGORICAL, "tree", "fold", K).fit(df)

    def cols(f):
        out = {c: prep.numeric_expr(f, c) for c in PREP_NUMERIC}
        out.update({c: F.coalesce(F.col(c), F.lit(prep.modes.get((f, c)))) for c in PREP_CATEGORICAL})
        return out
    res = _held_out(df, cols)
    return res.select("Id", "fold", *[r6(c).alias(c) for c in PREP_NUMERIC], *PREP_CATEGORICAL)


@query
def q_preprocess_linear(spark, sf_dir):
    """Linear preprocessor: median impute then standardise with the training
    fold's mean / population std of the imputed column."""
    from foldline.operators.preprocess import FoldPreprocessor
    df = folded_standin(spark, sf_dir)
    prep = FoldPreprocessor(PREP_NUMERIC, [], "linear", "fold", K).fit(df)
    res = _held_out(df, lambda f: {c: prep.numeric_expr(f, c) for c in PREP_NUMERIC})
    return res.select("Id", "fold", *[r6(c).alias(c) for c in PREP_NUMERIC])


@query
def q_one_hot(spark, sf_dir):
    """One-hot position of each (mode-imputed) category in its training fold's
    sorted vocabulary; unseen -> NULL (an all-zero row)."""
    from foldline.operators.preprocess import fold_modes
    df = folded_standin(spark, sf_dir)
    modes = fold_modes(df, PREP_CATEGORICAL, "fold", K)
    wide = encode.FoldDictionary(PREP_CATEGORICAL, "fold", K).fit(df).index(df.select("Id", "fold", *PREP_CATEGORICAL), PREP_CATEGORICAL, modes)
    return wide.select("Id", "fold", F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}_index").alias("hot_index")) for c in PREP_CATEGORICAL])))


@query
def q_category_prep(spark, sf_dir):
    df = standin(spark, sf_dir)
    out = impute.category_prep(df, PREP_NUMERIC, PREP_CATEGORICAL + ["MSSubClass"])
    return out.select("Id", *[r6(c).alias(c) for c in PREP_NUMERIC], *PREP_CATEGORICAL,
                      "MSSubClass")


# ---------------------------------------------------------------- MLlib base models (rows-only checks)
MODEL_NUMERIC = ["x_qty", "x_disc", "n_lines", "c_acctbal"]
MODEL_CATEGORICAL = ["prio", "o_orderstatus", "c_mktsegment"]
def model_tables(spark, sf_dir):
    """Order-based training / scoring tables for the MLlib base models."""
    from foldline.sources.tables import order_frame
    of = order_frame(spark, sf_dir)
    df = of.select(
        "o_orderkey", F.log1p("o_totalprice").alias("label"), F.col("qty").alias("x_qty"),
        (F.col("disc") * F.lit(100.0)).alias("x_disc"), "n_lines", "c_acctbal",
        F.when(bucket("o_orderkey", "prio_mask", 20) > 0, F.col("o_orderpriority")).alias("prio"),
        "o_orderstatus", "c_mktsegment", is_scoring("o_orderkey").alias("scoring"))
    df = folds.hash_fold(df, "o_orderkey", K, SEED)
    # read by every preprocessing statistic and every fold fit: both are made and written together, once
    df = stored(df)
    return df.where(~F.col("scoring")).drop("scoring"), df.where(F.col("scoring")).drop("scoring", "label", "fold")


def _base_model_query(name: str, params: dict | None = None):
    """Out-of-fold predictions of a base model at the registry's settings, or with ``params`` in their place."""
    def run(spark, sf_dir):
        from foldline.operators.models import REGISTRY
        from foldline.operators.preprocess import FoldPreprocessor
        from foldline.operators.stacking import oof_predict
        train, score = model_tables(spark, sf_dir)
        spec = REGISTRY[name]
        prep = FoldPreprocessor(MODEL_NUMERIC, MODEL_CATEGORICAL, spec.prep, "fold", K).fit(train)
        oof, _ = oof_predict(spec, prep, train, score, "o_orderkey", "label", "fold", K, params)
        return oof.select("o_orderkey", "fold", r6("pred").alias("pred"))
    return run


for _q, _m, _p in [("lasso_oof", "Linear_Lasso", None), ("gbt_oof", "XGBoost", housing.REDUCED_PARAMS["XGBoost"]), ("gbt_mae_oof", "CatBoost", None),
                   ("gbt_small_leaf_oof", "LightGBM", None), ("forest_oof", "ExtraTrees", None),
                   ("linear_ridge_oof", "Linear_Ridge", None)]:
    _f = _base_model_query(_m, _p)
    _f.__name__ = f"q_{_q}"
    _f.__doc__ = f"OOF predictions of the {_m} base model, {'reduced (see REDUCED_PARAMS)' if _p else 'at the registry settings'}, per-fold preprocessing."
    query(_f)


STUMP_NUMERIC, STUMP_CATEGORICAL = ["n_lines"], ["o_orderstatus", "c_mktsegment"]


@query
def q_boost_stump(spark, sf_dir):
    """The first tree, of depth 1, of each fold's boosted ensemble: feature, threshold (bin), gain and both leaf values."""
    from foldline.operators.boosting import BoostParams, fit_boosted
    from foldline.operators.preprocess import FoldPreprocessor
    train, _ = model_tables(spark, sf_dir)
    prep = FoldPreprocessor(STUMP_NUMERIC, STUMP_CATEGORICAL, "tree", "fold", K).fit(train)
    fit = fit_boosted(train, prep, BoostParams(rounds=1, depth=1, l1=0.5, l2=2.0, min_child=10, patience=None), "o_orderkey", k=K)
    rows = []
    for f in range(K):
        t = fit.trees[f][0]
        rows.append((f, (STUMP_NUMERIC + STUMP_CATEGORICAL)[t.feature[0]], t.threshold[0], t.gain[0], t.value[t.left[0]], t.value[t.right[0]], *fit.errors[f]))
    df = spark.createDataFrame(rows, "fold int, feature string, threshold int, gain double, left_value double, right_value double, error_before double, error_after double")
    return df.select("fold", "feature", "threshold", *[(F.floor(F.col(c) * 1e4 + 0.5) / 1e4).alias(c) for c in ("gain", "left_value", "right_value", "error_before", "error_after")])


@query
def q_boost_staged(spark, sf_dir):
    """The held-out error of every prefix of ten depth-2 rounds, in one pass over the rows."""
    from foldline.operators.boosting import BoostParams, fit_boosted
    from foldline.operators.preprocess import FoldPreprocessor
    train, _ = model_tables(spark, sf_dir)
    prep = FoldPreprocessor(MODEL_NUMERIC, MODEL_CATEGORICAL, "tree", "fold", K).fit(train)
    fit = fit_boosted(train, prep, BoostParams(rounds=10, depth=2, min_child=10, patience=None), "o_orderkey", k=K)
    return fit.staged_errors(train).select("fold", "rounds", r6("error").alias("error"))


@query
def q_ordered_target_stats(spark, sf_dir):
    """Each row's category mean over the rows before it in a hash order, with one row of the prior."""
    df = order_target(spark, sf_dir)
    out = encode.ordered_target_stats(df, ["o_orderpriority", "o_orderstatus"], "label", "o_orderkey", seed=SEED)
    return out.select("o_orderkey", r6("o_orderpriority_ots").alias("o_orderpriority_ots"), r6("o_orderstatus_ots").alias("o_orderstatus_ots"))


def baseline_spec():
    """Impute + one category against the rest + histogram boosting on the raw target, up to 100 rounds, ended by a patience of 10."""
    from foldline.operators.boosting import BoostParams
    from foldline.operators.models import ModelSpec
    return ModelSpec("Baseline", "tree", boost=BoostParams(rounds=100, step=0.1, depth=6, leaves=31, min_child=20, patience=10, max_bins=255))


@query
def q_baseline_cv(spark, sf_dir):
    """Baseline: tree preprocessing + boosted trees on the raw target; fold MAE."""
    from foldline.operators.preprocess import FoldPreprocessor
    from foldline.operators.stacking import oof_predict
    train, _ = model_tables(spark, sf_dir)
    train = train.withColumn("label", F.expm1("label"))
    prep = FoldPreprocessor(MODEL_NUMERIC, MODEL_CATEGORICAL, "tree", "fold", K).fit(train)
    oof, _ = oof_predict(baseline_spec(), prep, train, None, "o_orderkey", "label", "fold", K)
    agg = oof.groupBy("fold").agg(F.avg(F.abs(F.col("label") - F.col("pred"))).alias("mae"))
    return agg.select("fold", r6("mae").alias("mae"))


@query
def q_meta_select(spark, sf_dir):
    """Ridge vs ElasticNet meta model on the prediction table of two closed-form base models; lower MAE wins."""
    from foldline.operators.stacking import evaluate_meta
    train_p, score_p = _stack_inputs(spark, sf_dir)
    res = evaluate_meta(train_p, ["ridge", "te"], "label", score_p, "o_orderkey")
    row = (res.meta_name, float(res.mae), float(res.mape), float(res.ridge_mae), float(res.enet_mae), float(res.coefs["ridge"]), float(res.coefs["te"]))
    names = ["mae", "mape", "ridge_mae", "enet_mae"]
    return spark.createDataFrame([row], "meta_name string, " + ", ".join(f"{c} double" for c in [*names, "coef_ridge", "coef_te"])).select(
        "meta_name", *[(F.floor(F.col(c) * 1e4 + 0.5) / 1e4).alias(c) for c in names], "coef_ridge", "coef_te")


@query
def q_tune_enet(spark, sf_dir):
    """100-trial elastic-net meta search (log-uniform alpha, uniform l1_ratio); mean error in money, to 4 digits."""
    from foldline.operators.tune import elastic_net_search, sample_candidates
    train_p, _ = _stack_inputs(spark, sf_dir)
    res = elastic_net_search(train_p, ["ridge", "te"], sample_candidates(100, SEED))
    return res.select("trial", "alpha", "l1_ratio", (F.floor(F.col("mae") * 1e4 + 0.5) / 1e4).alias("mae"))


@query
def q_tune_gbt(spark, sf_dir):
    """Boosted-tree search by successive halving: six draws at 3 rounds, the best two at 9, the best one at 27; error in money."""
    from foldline.operators.preprocess import FoldPreprocessor
    from foldline.operators.tune import halving_search, sample_gbt
    train, _ = model_tables(spark, sf_dir)
    prep = FoldPreprocessor(MODEL_NUMERIC, MODEL_CATEGORICAL, "native", "fold", K).fit(train)
    rows = halving_search(train, prep, sample_gbt(6, SEED, depths=(2, 3)), "o_orderkey", rounds=3, seed=SEED, k=K)
    return spark.createDataFrame([(r["trial"], r["rounds"], r["depth"], r["step"], r["cv_mae"]) for r in rows],
                                 "trial int, rounds int, max_depth int, step_size double, cv_mae double")


@query
def q_read_csv_na(spark, sf_dir):
    """Stand-in rows written as CSV with NA for missing, read back with a schema."""
    from foldline.sources.csv import read_csv_na, write_csv_na
    df = standin(spark, sf_dir)
    path = _scratch(spark, "csv")
    write_csv_na(df, path)
    back = read_csv_na(spark, path, df.schema)
    return back.select(*_rounded(back, back.columns))


@query
def q_read_csv_typed(spark, sf_dir):
    """Training and scoring rows as two CSVs with stray tokens in whole-number and decimal columns, read back without a schema."""
    from foldline.plans.runner import split_standin
    from foldline.sources.csv import REJECTED, read_csv_typed, write_csv_na
    cols = ["Id", "LotArea", "LotFrontage", "n_lines", "Neighborhood", "MasVnrType"]
    paths = []
    for df in split_standin(spark, sf_dir):
        stray = df.withColumn("n_lines", F.col("BsmtFinSF2").cast("int")).select(
            "Id", F.when(F.col("Id") % 997 == 0, F.lit("n. a.")).otherwise(F.col("LotArea").cast("string")).alias("LotArea"),
            F.when(F.col("Id") % 991 == 0, F.lit("?")).otherwise(F.col("LotFrontage").cast("string")).alias("LotFrontage"), "n_lines", "Neighborhood", "MasVnrType")
        paths.append(_scratch(spark, "csv"))
        write_csv_na(stray, paths[-1])
    train, score = read_csv_typed(spark, *paths)
    both = train.unionByName(score)
    return both.select(*_rounded(both, cols), F.size(REJECTED).cast("long").alias("n_rejected"))


@query
def q_step_ablation(spark, sf_dir):
    """CV MAE of the registry's ridge on the recipe with and without the domain features; the steps before are run once."""
    from foldline.plans.runner import ablation, split_standin
    recipe = housing.Recipe()
    out = ablation(*split_standin(spark, sf_dir, recipe.id_col), recipe, "add_advanced_features")
    return out.select("model", *[r2(c).alias(c) for c in ("mae_with", "mae_without", "delta")])


# ---------------------------------------------------------------- end to end
@query
def q_stacked_submission(spark, sf_dir):
    """The whole housing run: outliers, recipe, OOF target encoding, drop list,
    skew fix, the six base models out of fold with ``REDUCED_PARAMS`` (boosted
    models take longer steps to their best round, 20 trees of depth 8), the meta
    model; returns the ``Id, SalePrice`` scoring frame (money rounded to cents)."""
    from foldline.plans.runner import prepare, run, split_standin
    recipe = housing.Recipe(model_params=dict(housing.REDUCED_PARAMS))
    train_raw, score_raw = split_standin(spark, sf_dir, recipe.id_col)
    res = run(prepare(train_raw, score_raw, recipe), recipe)
    return res.submission.select("Id", r2("SalePrice").alias("SalePrice"))
