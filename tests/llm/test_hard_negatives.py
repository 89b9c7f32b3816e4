"""Hard negatives against brute force on small tables with odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldline.llm import hard_negatives as hn

SCHEMA = "id long, label int, raw array<float>, score long, means string"


def brute(rows, every=5, k=5, low=80, high=100):
    good = [(i, y, [math.floor(256 * x) for x in v]) for i, y, v in rows
            if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, y, q in good:
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(q, v)), j, z) for j, z, v in good if len(v) == len(q)]
        for p, j, _ in sorted(x for x in scored if x[2] == y and x[1] != i)[:k]:
            fits = sorted(x for x in scored if x[2] != y and low * -p <= 100 * -x[0] <= high * -p)
            out += [(i, j, r, n, -p, -s) for r, (s, n, _) in enumerate(fits[:k], 1)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, "m") for r in rows], SCHEMA).repartition(3)
    df = df.withColumn("vector", hn.scaled(F.col("raw")))
    return sorted(tuple(r) for r in hn.hard_negatives(df, F.col("id") % 5 == 0, **options).collect())


def vectors(seed, n, size):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(6, size))
    x = (centre[rng.integers(0, 6, n)] + rng.normal(scale=0.4, size=(n, size))).astype(np.float32)
    return [(int(i), int(rng.integers(0, 3)), x[i].tolist()) for i in range(n)]


@pytest.mark.parametrize("size,anchor_bytes", [(20, 0), (64, 4000), (3, 0)])
def test_hard_negatives(spark, size, anchor_bytes):
    rows = vectors(size, 150, size)
    rows += [(200 + i, 1, rows[0][2]) for i in range(8)] + [(300 + i, 0, rows[0][2]) for i in range(8)]  # ties
    rows += [rows[3], rows[5], (400, None, rows[0][2]), (405, 1, None), (None, 1, rows[0][2]), (410, 1, [1.0, None]), (415, 1, [float("nan")] * size),
             (420, 2, [float("inf")] * size), (425, 2, []), (430, 2, []), (431, 1, []), (435, 1, [0.5, 0.25]), (436, 1, [0.5, 0.25]), (437, 2, [0.5, 0.125])]
    assert mined(spark, rows, anchor_bytes=anchor_bytes) == brute(rows)


def test_empty_and_far(spark):
    assert mined(spark, []) == []
    with pytest.raises(Exception, match="too large"):
        mined(spark, [(0, 1, [1e30, 1e30])])


def test_bounds_hold_at_every_level():
    v = np.random.default_rng(1).integers(-300, 300, (60, 37))
    block = hn.Block(np.arange(60), np.zeros(60), v, *hn.summaries(v))
    exact, width = v @ v.T, []
    for level in range(len(hn.LEVELS)):
        least, most = hn.bounds(block, block, level)
        assert (least <= exact).all() and (exact <= most).all()
        width.append((most - least).mean())
    assert width == sorted(width, reverse=True)
