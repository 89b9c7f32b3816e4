"""Blocks of the boosting state against plain loops, and tables that are written once in columns."""

import numpy as np
import pytest

from foldline.operators import boosting
from foldline.operators.boosting import Block, BoostParams, Tree, Walk

SIZES, CATEGORICAL = np.array([9, 30, 4, 4]), np.array([False, False, True, True])


def grown(rng, leaves):
    tree, ends = Tree(), [0]
    while len(ends) < leaves:
        j = int(rng.integers(0, 4))
        node = ends.pop(int(rng.integers(0, len(ends))))
        ends += tree.split(node, j, int(rng.integers(0, SIZES[j])), bool(rng.integers(0, 2)), 1.0, (float(rng.normal()), float(rng.normal())))
    return tree


def plain(tree, x):
    node = 0
    while tree.left[node] >= 0:
        j, v = tree.feature[node], int(x[tree.feature[node]])
        go = tree.missing_left[node] if v == 0 else v == tree.threshold[node] if CATEGORICAL[j] else v <= tree.threshold[node]
        node = (tree.left if go else tree.right)[node]
    return node


@pytest.mark.parametrize("leaves", [1, 2, 17, 64, 65, 90])
def test_rows_end_where_a_plain_descent_ends(leaves):
    rng = np.random.default_rng(leaves)
    tree, x = grown(rng, leaves), np.stack([rng.integers(0, s + 1, 300) for s in SIZES]).astype(np.uint8)
    assert Walk(tree, SIZES, CATEGORICAL)(x, 300).tolist() == [plain(tree, x[:, i]) for i in range(300)]


@pytest.mark.parametrize("loss", ["squared", "absolute"])
@pytest.mark.parametrize("sampled", [False, True])
def test_sums_of_bundled_features_are_those_of_each(loss, sampled):
    rng = np.random.default_rng(7)
    p = BoostParams(loss=loss, subsample=0.6 if sampled else 1.0, bagging_temperature=0.5 if sampled else 0.0)
    n, k, tree = 400, 3, grown(rng, 6)
    x = np.stack([rng.integers(0, s + 1, n) for s in SIZES]).astype(np.uint8)
    fold, y = np.sort(rng.integers(0, k, n)), np.round(rng.normal(size=n), 1)
    preds = [np.round(rng.normal(size=n), 1) for _ in range(k)]
    block = Block(rng.integers(0, 1 << 60, n), np.searchsorted(fold, np.arange(k + 1)), y, x, preds).drawn(p, 4, range(k))
    nodes = [i for i in range(len(tree.value)) if tree.left[i] < 0][:3]
    slots = np.full(len(tree.value), -1)
    slots[nodes] = np.arange(3)
    assert [len(b) for b in boosting._bundles([0, 1, 2, 3], SIZES)] == [3, 1]
    got = dict(boosting._sums({1: Walk(tree, SIZES, CATEGORICAL)}, {1: slots}, {1: [0, 1, 2, 3]}, SIZES, p, k, True)(iter([block])))
    for j in range(4):
        want = np.zeros((2, 3, SIZES[j] + 1))
        for i in range(n):
            s = slots[plain(tree, x[:, i])]
            if fold[i] == 1 or s < 0 or sampled and not block.draw[1][i]:
                continue
            d, h = preds[1][i] - y[i], block.h[1][i] if sampled else 1.0
            want[0, s, x[j, i]] += np.rint((np.sign(d) if loss == "absolute" else d) * h * 2.0 ** 30) * 2.0 ** -30
            want[1, s, x[j, i]] += h
        assert got[0, 1, j].tolist() == want.reshape(2, -1).tolist()
    d = [preds[f][fold == f] - y[fold == f] for f in range(k)]
    assert [got[1, f, 0].tolist() for f in range(k)] == [pytest.approx([(abs(v) if loss == "absolute" else v * v).sum(), len(v)]) for v in d]


def test_order_tables_are_made_once_and_written_in_columns(spark, sf_dir):
    from foldline.plans.catalog import model_tables
    train, score = model_tables(spark, sf_dir)
    assert train.inputFiles() and set(train.inputFiles()) == set(score.inputFiles())
    assert "scoring" not in train.columns and set(train.columns) - set(score.columns) == {"label", "fold"}
    assert train.count() > 4 * score.count() > 0


def test_tables_between_the_phases_are_written_in_columns(spark, sf_dir):
    from foldline.plans.housing import Recipe
    from foldline.plans.runner import begin, split_standin
    raw = split_standin(spark, sf_dir)
    train, score = begin(*raw, Recipe())
    assert all("stored-" in f for d in (train, score) for f in d.inputFiles())
    assert score.count() == raw[1].count() and {r.Id for r in score.select("Id").collect()} == {r.Id for r in raw[1].select("Id").collect()}
