"""Error metrics as DataFrames (partial aggregates, one pass each)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPS = float(np.finfo(np.float64).eps)


def abs_error(y: Column, p: Column, log_scale: bool = True) -> Column:
    """|y - p| on the original scale (``expm1`` both sides when log targets)."""
    if log_scale:
        y, p = F.expm1(y), F.expm1(p)
    return F.abs(y - p)


def pct_error(y: Column, p: Column, log_scale: bool = True) -> Column:
    """|y - p| / max(|y|, eps): no division error on a zero label."""
    if log_scale:
        y, p = F.expm1(y), F.expm1(p)
    return F.abs(y - p) / F.greatest(F.abs(y), F.lit(EPS))


def mae(df: DataFrame, label: str, pred: str, log_scale: bool = True) -> float:
    return df.agg(F.avg(abs_error(F.col(label), F.col(pred), log_scale))).first()[0]


def metric_table(preds: DataFrame, label: str = "label", pred: str = "pred",
                 model_col: str = "model", fold_col: str = "fold",
                 log_scale: bool = True) -> DataFrame:
    """MAE and MAPE per (model, fold) and per model overall.

    The rows are summed once per (model, fold); the rollup runs over those few
    sums. Long output ``model, fold, metric, value``; ``fold`` is NULL on the
    per-model rows. A group without an error value has a NULL metric.
    """
    y, p = F.col(label), F.col(pred)
    ae, pe = abs_error(y, p, log_scale), pct_error(y, p, log_scale)
    sums = preds.groupBy(model_col, fold_col).agg(
        F.sum(ae).alias("_ae"), F.count(ae).alias("_an"), F.sum(pe).alias("_pe"), F.count(pe).alias("_pn"))
    agg = (sums.rollup(model_col, fold_col)
           .agg(F.try_divide(F.sum("_ae"), F.sum("_an")).alias("mae"),
                F.try_divide(F.sum("_pe"), F.sum("_pn")).alias("mape"))
           .where(F.col(model_col).isNotNull()))
    return agg.select(model_col, fold_col,
                      F.inline(F.array(F.struct(F.lit("mae").alias("metric"), F.col("mae").alias("value")),
                                       F.struct(F.lit("mape").alias("metric"), F.col("mape").alias("value")))))


def cv_summary(metrics: DataFrame, model_col: str = "model", fold_col: str = "fold",
               metric: str = "mae") -> DataFrame:
    """Mean and (population) standard deviation of a per-fold metric."""
    per_fold = metrics.where(F.col(fold_col).isNotNull() & (F.col("metric") == metric))
    return per_fold.groupBy(model_col).agg(F.avg("value").alias(f"{metric}_mean"),
                                           F.stddev_pop("value").alias(f"{metric}_std"),
                                           F.count(F.lit(1)).alias("n_folds"))


def blend_sweep(df: DataFrame, label: str, a: str, b: str, weights: Sequence[float],
                log_scale: bool = True) -> DataFrame:
    """MAE of ``w*a + (1-w)*b`` for every weight, in a single aggregation pass
    (one aggregate per weight, unpivoted) rather than a join with a weight table."""
    y = F.col(label)
    aggs = [F.avg(abs_error(y, F.lit(w) * F.col(a) + F.lit(1.0 - w) * F.col(b), log_scale)).alias(f"m{i}")
            for i, w in enumerate(weights)]
    rows = F.array(*[F.struct(F.lit(float(w)).alias("weight"), F.col(f"m{i}").alias("mae"))
                     for i, w in enumerate(weights)])
    return df.agg(*aggs).select(F.inline(rows))
