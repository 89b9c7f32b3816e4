"""Exact medians of the other folds, whatever the sketches say."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldline.operators import preprocess


def expected(rows, j, k):
    out = {}
    for f in range(k):
        v = [r[j] for r in rows if r[1] is not None and r[1] != f and r[j] is not None and r[j] == r[j]]
        if v:
            out[f] = float(np.median(v))
    return out


@pytest.mark.parametrize("accuracy,grid", [(10_000, 200), (20, 7), (10_000, 1)])
def test_fold_medians(spark, monkeypatch, accuracy, grid):
    monkeypatch.setattr(preprocess, "ACCURACY", accuracy)
    monkeypatch.setattr(preprocess, "GRID", grid)
    rng = np.random.default_rng(grid)
    rows = [(i, int(rng.integers(0, 4)) if i % 50 else None, None if i % 9 == 0 else float(rng.normal(size=1)[0]), float(rng.integers(0, 3)),
             1e300 if i % 2 else -1e-300, None, int(rng.integers(-5, 5)) if i % 3 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, fold int, a double, b double, c double, d double, e int").repartition(5)
    got = preprocess.fold_medians(df, ["a", "b", "c", "d", "e"], "fold", 5)
    for j, name in enumerate(["a", "b", "c", "d", "e"], 2):
        assert {f: m for (f, c), m in got.items() if c == name} == pytest.approx(expected(rows, j, 5))


def test_wrong_brackets_are_widened(spark, monkeypatch):
    real = preprocess._brackets
    monkeypatch.setattr(preprocess, "_brackets", lambda s, folds, p: (100.0, 200.0, real(s, folds, p)[2]))
    df = spark.createDataFrame([(i % 2, float(i)) for i in range(41)], "fold int, a double")
    assert preprocess.fold_medians(df, ["a"], "fold", 2) == {(0, "a"): 20.0, (1, "a"): 20.0}


def test_values_inside_are_few(spark):
    df = spark.range(200_000).select((F.col("id") % 5).cast("int").alias("fold"), F.rand(3).alias("a"))
    sketch = {r.fold: (r.n, r.q) for r in df.groupBy("fold").agg(F.count("a").alias("n"), F.percentile_approx("a", [i / 200 for i in range(201)], 10_000).alias("q")).collect()}
    low, high, n = preprocess._brackets(sketch, [1, 2, 3, 4], 0.5)
    assert n == 160_000 and df.where(F.col("fold") != 0).where(F.col("a").between(low, high)).count() < 0.02 * n


def test_a_pass_over_columns_sends_equal_values_together_and_counts_what_lies_below(monkeypatch):
    """A row of the result for each value, not for each row and column of the table."""
    import pyarrow as pa
    monkeypatch.setattr(preprocess, "HELD_VALUES", 3)
    rng = np.random.default_rng(8)
    fold, v = rng.integers(0, 3, 900).astype(np.int32), np.round(rng.normal(size=900), 1)
    batches = [pa.RecordBatch.from_arrays([pa.array(fold[a:a + 300]), pa.array(v[a:a + 300], mask=np.arange(300) % 7 == 0)], ["fold", "_0"]) for a in (0, 300, 600)]
    got: dict = {}
    for b in preprocess._inside(["a"], {(1, "a"): (-0.2, 0.3, 0)})(iter(batches)):
        for r in b.to_pylist():
            got[r["value"]] = got.get(r["value"], 0) + r["_w"]
    own = v[(fold != 1) & (np.arange(900) % 300 % 7 > 0)]
    assert got.pop(None) == (own < -0.2).sum()
    assert got == {x: (own == x).sum() for x in np.unique(own[(own >= -0.2) & (own <= 0.3)])}
