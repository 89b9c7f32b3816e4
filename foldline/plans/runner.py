"""End-to-end run of a recipe: load -> outliers -> recipe steps -> OOF target
encoding -> drop -> skew -> per-fold preprocessors -> base models (OOF) ->
meta model -> submission frame and metric table.

Tables are written as Parquet in ``spark.checkpoint.dir`` between the phases:
each is read many times, mostly in a few of its columns.
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldline.functions.columns import numeric_columns, string_columns
from foldline.functions.hashing import bucket
from foldline.operators.encode import target_encode
from foldline.operators.folds import hash_fold
from foldline.operators.impute import remove_outliers
from foldline.operators.metrics import metric_table
from foldline.operators.models import resolve
from foldline.operators.preprocess import FoldPreprocessor
from foldline.operators.skew import SkewCorrector
from foldline.operators.stacking import evaluate_meta, fit_folds, long_predictions, prediction_table
from foldline.operators.tune import best_trial, elastic_net_search, sample_candidates
from foldline.plans.housing import REDUCED_PARAMS, Recipe, outlier_rule
from foldline.plans.recipe import run_steps
from foldline.session import stored
from foldline.sources.csv import REJECTED, read_csv_typed
from foldline.sources.standin import housing_standin

log = logging.getLogger(__name__)


@dataclass
class Prepared:
    train: DataFrame          # id, fold, label, features...
    score: DataFrame          # id, features...
    numeric: list
    categorical: list
    skewed: list


def split_standin(spark: SparkSession, sf_dir: str, id_col: str = "Id"):
    """Training and scoring tables: a hash hold-out of the stand-in rows."""
    raw = housing_standin(spark, sf_dir)
    hold = bucket(F.col(id_col), "holdout", 10) == 0
    return raw.where(~hold), raw.where(hold).drop("SalePrice")


def begin(train_raw: DataFrame, score_raw: DataFrame, recipe: Recipe, remove_outlier_rows: bool = True) -> tuple[DataFrame, DataFrame]:
    """The training table without outliers and with its log label, and the scoring table, both read once and written."""
    if remove_outlier_rows:
        train_raw = remove_outliers(train_raw, outlier_rule(train_raw))
    # the recipe fits several statistics on each table: read the source once
    train_raw, score_raw = stored(train_raw), stored(score_raw)
    return train_raw.withColumn("label", F.log1p(F.col(recipe.target_col))).drop(recipe.target_col), score_raw


def through_steps(train: DataFrame, score: DataFrame, steps: list) -> tuple[DataFrame, DataFrame]:
    """Both tables after the steps. Each is cleaned with its own statistics, as the reference does; the two fits run side by side."""
    with ThreadPoolExecutor(max_workers=2) as pool:
        return tuple(pool.map(lambda d: run_steps(d, steps), [train, score]))


def finish(x: DataFrame, xt: DataFrame, recipe: Recipe) -> Prepared:
    """Folds, target encoding, drop list and skew fix after the recipe's steps."""
    idc = recipe.id_col
    x = hash_fold(x, idc, recipe.n_splits, recipe.random_state)
    x, xt = target_encode(x, xt, recipe.target_encode_cols, "label")
    drop = [c for c in recipe.drop_features if c != idc]
    x, xt = x.drop(*drop), xt.drop(*drop)
    x = stored(x)
    skew = SkewCorrector(recipe.skew_threshold, exclude=[idc, "label", "fold"]).fit(x)
    x, xt = skew.transform(x), skew.transform(xt)
    x, xt = stored(x), stored(xt)
    numeric = numeric_columns(x.schema, exclude=[idc, "label", "fold"])
    categorical = string_columns(x.schema, exclude=[idc])
    return Prepared(x, xt, numeric, categorical, skew.columns)


def prepare(train_raw: DataFrame, score_raw: DataFrame, recipe: Recipe,
            remove_outlier_rows: bool = True) -> Prepared:
    """The tables that the models see: ``begin``, the recipe's steps, ``finish``."""
    train, score = begin(train_raw, score_raw, recipe, remove_outlier_rows)
    return finish(*through_steps(train, score, recipe.steps), recipe)


@dataclass
class RunResult:
    oof: DataFrame
    score_preds: DataFrame
    metrics: DataFrame
    meta: object
    submission: DataFrame
    wide: DataFrame           # id, fold, label, a column for each model


def run(prepared: Prepared, recipe: Recipe, parallelism: int = 5,
        model_parallelism: int = 3) -> RunResult:
    idc, k = recipe.id_col, recipe.n_splits
    x = prepared.train
    base = FoldPreprocessor(prepared.numeric, prepared.categorical, "tree", "fold", k)
    specs = resolve(recipe.active_models)
    preps = {}
    tree = base.fit(x) if specs else None
    for spec in specs:
        if spec.prep not in preps:
            preps[spec.prep] = tree if spec.prep == "tree" else \
                base.with_kind(tree, spec.prep, x)

    def one_model(spec):
        return fit_folds(spec, preps[spec.prep], x, idc, "label", "fold", k, recipe.model_params.get(spec.name), parallelism)

    # models are independent Spark jobs: a few run side by side (MLlib ones with
    # their fold fits in parallel), sharing the cluster
    with ThreadPoolExecutor(max_workers=max(1, model_parallelism)) as pool:
        scorers = dict(zip([s.name for s in specs], pool.map(one_model, specs), strict=True))
    names = list(scorers)
    # one scan of each table for all models, read several times afterwards
    wide = stored(prediction_table(scorers, x, [idc, "fold", "label"], True))
    score_wide = stored(prediction_table(scorers, prepared.score, [idc], False))
    long = long_predictions(wide, names, [idc, "fold", "label"])
    score_long = long_predictions(score_wide, names, [idc])
    meta = evaluate_meta(wide, names, "label", score_wide, idc)
    mt = metric_table(long, "label", "pred", "model", "fold")
    spark = x.sparkSession
    meta_long = spark.createDataFrame(
        [(f"meta_{meta.meta_name}", None, "mae", float(meta.mae)),
         (f"meta_{meta.meta_name}", None, "mape", float(meta.mape))],
        "model string, fold int, metric string, value double")
    submission = meta.final_pred.select(F.col(idc).alias("Id"), F.col("pred").alias("SalePrice"))
    return RunResult(long, score_long, mt.unionByName(meta_long), meta, submission, wide)


FLAGSHIP_MODELS = ["Linear_Ridge", "Linear_Lasso", "XGBoost"]


def flagship_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The housing recipe with three of the six models, the boosted one with longer steps (``REDUCED_PARAMS``); returns the metric table."""
    recipe = Recipe(active_models=FLAGSHIP_MODELS, model_params=dict(REDUCED_PARAMS))
    train_raw, score_raw = split_standin(spark, sf_dir, recipe.id_col)
    prepared = prepare(train_raw, score_raw, recipe)
    return run(prepared, recipe).metrics


def tune_meta(result: RunResult, n_trials: int = 100, seed: int = 42) -> DataFrame:
    """Every trial of the meta search over the run's models: (trial, alpha, l1_ratio, mae), on the predictions already made."""
    names = [c for c in result.wide.columns[3:]]
    return elastic_net_search(result.wide, names, sample_candidates(n_trials, seed))


def ablation(train_raw: DataFrame, score_raw: DataFrame, recipe: Recipe, step_name: str,
             models: list | None = None) -> DataFrame:
    """CV MAE per model with and without one step of the recipe, and the difference (``without - with``).

    The steps before it are run once and written; both variants go on from there.
    """
    models = models or ["Linear_Ridge"]
    names = [s.__name__ for s in recipe.steps]
    at = names.index(step_name)
    shared = through_steps(*begin(train_raw, score_raw, recipe), recipe.steps[:at])
    shared = tuple(stored(d) for d in shared)
    spark, maes = train_raw.sparkSession, {}
    for variant, steps in (("with", recipe.steps[at:]), ("without", recipe.steps[at + 1:])):
        prepared = finish(*through_steps(*shared, steps), recipe)
        res = run(prepared, replace(recipe, active_models=models))
        rows = res.metrics.where(F.col("fold").isNull() & (F.col("metric") == "mae") & ~F.col("model").startswith("meta_")).collect()
        maes |= {(variant, r["model"]): float(r["value"]) for r in rows}
    table = [(m, maes["with", m], maes["without", m], maes["without", m] - maes["with", m]) for m in models]
    return spark.createDataFrame(table, "model string, mae_with double, mae_without double, delta double")


def read_housing_csv(spark: SparkSession, train_csv: str, test_csv: str):
    """Training and scoring CSV with the types of both together; cells that don't fit are missing and counted in the log."""
    frames = read_csv_typed(spark, train_csv, test_csv)
    for path, df in zip((train_csv, test_csv), frames, strict=True):
        n = df.agg(F.sum(F.size(REJECTED))).first()[0]
        if n:
            log.warning("%s: %d cells don't fit their column's type and count as missing", path, n)
    return tuple(df.drop(REJECTED) for df in frames)


def main(argv=None) -> None:
    """Command line: the whole run from two CSVs (or the driver tables) to a
    submission folder ``Id,SalePrice``; prints the metric table."""
    import argparse

    from foldline.session import ensure_checkpoint_dir
    from foldline.sources.csv import write_submission
    ap = argparse.ArgumentParser(prog="python -m foldline")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--train-csv")
    src.add_argument("--sf-dir", help="driver parquet tables (housing-shaped stand-in)")
    ap.add_argument("--test-csv")
    ap.add_argument("--out", required=True, help="submission folder")
    ap.add_argument("--models", default=",".join(Recipe().active_models))
    ap.add_argument("--single-file", action="store_true")
    ap.add_argument("--metrics", help="folder for the metric table as CSV")
    ap.add_argument("--tune", type=int, default=0, metavar="TRIALS", help="search the elastic-net meta model over the models' predictions")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("foldline").getOrCreate()
    ensure_checkpoint_dir(spark)
    recipe = Recipe(active_models=[m for m in args.models.split(",") if m])
    if args.train_csv:
        if not args.test_csv:
            ap.error("--test-csv is required with --train-csv")
        train_raw, score_raw = read_housing_csv(spark, args.train_csv, args.test_csv)
    else:
        train_raw, score_raw = split_standin(spark, args.sf_dir, recipe.id_col)
    res = run(prepare(train_raw, score_raw, recipe), recipe)
    write_submission(res.submission, args.out, single_file=args.single_file)
    if args.metrics:
        res.metrics.write.mode("overwrite").option("header", True).csv(args.metrics)
    for r in res.metrics.orderBy("model", "fold", "metric").toLocalIterator():
        print(f"{r['model']:<24} fold {'all' if r['fold'] is None else r['fold']:<4} {r['metric']:<5} {r['value']:.4f}")
    if args.tune:
        best = best_trial(tune_meta(res, args.tune, recipe.random_state)).first()
        print(f"tuned meta: alpha={best['alpha']:.6g} l1_ratio={best['l1_ratio']:.4f} cv mae={best['mae']:.4f} ({args.tune} trials)")
    print(f"meta: {res.meta.meta_name} mae={res.meta.mae:.4f} mape={res.meta.mape:.4f} "
          f"coefs={res.meta.coefs}")
