"""Penalty parity and the Gram solvers against closed forms."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression

from foldline.operators import linear


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    n = 300
    x = rng.normal(size=(n, 3)) * [1.0, 2.0, 0.5] + [5.0, -1.0, 0.0]
    y = x @ [2.0, -0.3, 2.1] + 1.0 + rng.normal(size=n)
    rows = [(int(i), int(i % 5), *map(float, x[i]), float(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id int, fold int, a double, b double, c double, y double")
    return df, x, y


def closed_ridge(x, y, alpha):
    xm, ym = x.mean(0), y.mean()
    xc, yc = x - xm, y - ym
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    return w, ym - xm @ w


def test_gram_ridge_matches_closed_form(data):
    df, x, y = data
    fs = linear.fold_stats(df, ["a", "b", "c"], "y", "fold")
    fit = linear.ridge_fit(fs, fs.total, 10.0)
    w, b = closed_ridge(x, y, 10.0)
    assert np.allclose(fit.coef, w, atol=1e-9) and abs(fit.intercept - b) < 1e-9
    ids = np.arange(len(y))
    tr = ids % 5 != 2
    fit2 = linear.ridge_fit(fs, fs.train(2), 10.0)
    w2, b2 = closed_ridge(x[tr], y[tr], 10.0)
    assert np.allclose(fit2.coef, w2, atol=1e-9) and abs(fit2.intercept - b2) < 1e-9


def test_mllib_ridge_penalty_conversion(data):
    df, x, y = data
    w, _ = closed_ridge(x, y, 10.0)
    reg, enp = linear.mllib_penalty(10.0, 0.0, len(y), float(np.std(y)), ridge=True)
    va = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features")
    m = LinearRegression(regParam=reg, elasticNetParam=enp, standardization=False, solver="normal",
                         labelCol="y").fit(va.transform(df))
    assert np.allclose(m.coefficients.toArray(), w, atol=1e-6)


def coordinate_descent(x, y, alpha, l1):
    n = len(y)
    xm, ym = x.mean(0), y.mean()
    xc, yc = x - xm, y - ym
    w = np.zeros(x.shape[1])
    for _ in range(20000):
        for j in range(len(w)):
            r = yc - xc @ w + xc[:, j] * w[j]
            rho = xc[:, j] @ r / n
            w[j] = np.sign(rho) * max(abs(rho) - alpha * l1, 0) / (xc[:, j] @ xc[:, j] / n + alpha * (1 - l1))
    return w


def test_gram_elastic_net_matches_direct_cd(data):
    df, x, y = data
    fs = linear.fold_stats(df, ["a", "b", "c"], "y", None)
    fit = linear.elastic_net_fit(fs, fs.per_fold[0], 0.1, 0.5)
    assert np.allclose(fit.coef, coordinate_descent(x, y, 0.1, 0.5), atol=1e-7)


def test_mllib_ridge_lbfgs_uses_sample_std(data):
    from foldline.operators.models import FitContext
    df, x, y = data
    w, _ = closed_ridge(x, y, 10.0)
    ctx = FitContext(len(y), float(np.std(y)), n_features=5000)   # wide -> l-bfgs
    assert ctx.solver == "l-bfgs"
    reg, enp = linear.mllib_penalty(10.0, 0.0, len(y), ctx.solver_label_std, ridge=True)
    va = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features")
    m = LinearRegression(regParam=reg, elasticNetParam=enp, standardization=False, solver="l-bfgs",
                         maxIter=1000, tol=1e-12, labelCol="y").fit(va.transform(df))
    assert np.allclose(m.coefficients.toArray(), w, atol=1e-4)
