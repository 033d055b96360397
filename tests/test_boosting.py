"""Distributed histogram boosting against a plain numpy version on two sizes."""

import numpy as np
import pandas as pd
import pytest

from opsledger.operators import histogram_boosting as hb


def data(seed, n):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 7, n), rng.integers(0, 2, n), np.round(rng.random(n), 2), np.full(n, 3.0)])
    y = np.round(900 + 300 * x[:, 0] * (x[:, 1] > 3) + 200 * np.sin(6 * x[:, 3]) + rng.normal(size=n) * 20, 2)
    return x, y


def plain_boosting(bins, y, base, p):
    """Trees one split at a time, each leaf searched on its own rows: [(splits, {leaf: value})], predictions."""
    target, prediction, trees = np.rint(y * hb.SCALE), np.full(len(y), float(base)), []

    def best(rows, g):
        found = None
        for f in range(bins.shape[1]):
            for b in range(int(bins[:, f].max()) + 1):
                left = rows[bins[rows, f] <= b]
                if len(left) < p.least_rows or len(rows) - len(left) < p.least_rows:
                    continue
                gl, ga = g[left].sum() / hb.SCALE, g[rows].sum() / hb.SCALE
                gr = (g[rows].sum() - g[left].sum()) / hb.SCALE
                gain = gl**2 / (len(left) + p.l2) + gr**2 / (len(rows) - len(left) + p.l2) - ga**2 / (len(rows) + p.l2)
                if gain > 0 and (found is None or gain > found[0]):
                    found = (gain, f, b)
        return found

    for _ in range(p.iterations):
        g = prediction - target
        rows = {1: np.arange(len(y))}
        able, splits = {1: best(rows[1], g)}, []
        while len(rows) < p.leaves and any(able.values()):
            node = max((k for k in able if able[k]), key=lambda k: (able[k][0], -k))
            _, f, b = able.pop(node)
            splits.append((node, f, b))
            own = rows.pop(node)
            for child, part in ((2 * node, own[bins[own, f] <= b]), (2 * node + 1, own[bins[own, f] > b])):
                rows[child], able[child] = part, best(part, g)
        values = {k: np.rint(-p.step * g[r].sum() / (len(r) + p.l2)) for k, r in rows.items()}
        for k, r in rows.items():
            prediction[r] += values[k]
        trees.append((splits, values))
    return trees, prediction


@pytest.mark.parametrize(("n", "bins", "iterations"), [(400, 255, 8), (3000, 24, 18)])
def test_trees_equal_numpy(spark, monkeypatch, n, bins, iterations):
    monkeypatch.setattr(hb, "BLOCK", 500)  # several blocks and stores
    p = hb.Params(iterations=iterations, bins=bins, leaves=9)
    x, y = data(n, n)
    names = list("abcde")
    frame = pd.DataFrame(x, columns=names).assign(target=y)
    frame = pd.concat([frame.assign(fold=0), frame.iloc[: n // 2].assign(fold=3)])
    models = hb.fit(spark.createDataFrame(frame).repartition(3), names, p)
    again = hb.fit(spark.createDataFrame(frame.iloc[::-1]).repartition(7), names, p)
    for fold, rows in ((0, n), (3, n // 2)):
        m = models[fold]
        assert [list(b) for b in m.bounds] == [list(b) for b in again[fold].bounds]
        want, prediction = plain_boosting(m.binned(x[:rows]), y[:rows], m.base, p)
        assert m.base / hb.SCALE == pytest.approx(y[:rows].mean(), abs=1e-3)
        for tree, other, (splits, values) in zip(m.trees, again[fold].trees, want, strict=True):
            assert tree.splits == splits == other.splits
            assert dict(zip(tree.nodes, tree.values)) == values == dict(zip(other.nodes, other.values))
        assert (m.predict(x[:rows]) == prediction / hb.SCALE).all()


def test_bins_are_about_equal_and_exact_for_few_values(spark):
    x, y = data(1, 5000)
    frame = pd.DataFrame(x, columns=list("abcde")).assign(target=y, fold=1)
    m = hb.feature_bins(spark.createDataFrame(frame), list("abcde"), 50)[1]
    bins = m.binned(x)
    assert [len(np.unique(bins[:, k])) for k in (1, 2, 4)] == [7, 2, 1]
    n = np.bincount(bins[:, 0])
    assert len(n) == 50 and n.max() <= 2.2 * 5000 / 50
    assert (np.diff(bins[np.argsort(x[:, 0]), 0]) >= 0).all()


def test_no_rows(spark):
    with pytest.raises(ValueError, match="no training rows"):
        hb.fit(spark.createDataFrame([], "fold int, a double, target double"), ["a"])
