"""Gradient boosting on histograms, many groups of rows (folds) trained side by side.

Every feature is cut into at most ``bins`` bins of about equal counts. A tree grows best leaf
first up to ``leaves`` leaves; a leaf's histograms (rows and gradient sums per feature and bin)
decide its best split, with gain G^2 / (n + l2). All leaves of all folds that a level needs come
from one pass: tasks sum their rows into arrays of (node, feature, bin), a tree of tasks adds the
arrays up, and the driver gets a few packed sums of folds x leaves x features x bins numbers, whatever
the data. Only left children are counted; a right child has the rest of its parent. Some hundred
short passes are why this one loop runs on partitions of the stored blocks.

Growing level by level is exact: a level also asks for the children of every open leaf that could
still be split within the leaf budget, so the best-first order never waits for a leaf twice.

Targets, leaf values and predictions are whole numbers of 1/``SCALE``, so gradient sums don't
depend on partitions or retries, and neither does the model; and a new tree's root needs no pass:
its histogram is that of the last tree's leaves, each moved by its value. Rows are stored as blocks of bytes with their prediction;
tasks replay only the trees grown since the last store (every ``STORE_EVERY`` trees).
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import dropped, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Equal-width cells between a feature's least and largest value; bins are runs of cells.
CELLS = 1 << 16
#: Whole units per unit of the target.
SCALE = 1000
#: Rows of a block; trees between two stores of the predictions.
BLOCK, STORE_EVERY = 1 << 17, 10
#: Tasks whose sums the driver adds up at once; beyond, tasks add up each other's first.
FEW = 4
_BLOCKS = "fold int, n int, bins binary, target binary, prediction binary"


@dataclass(frozen=True)
class Params:
    """Iterations, leaves, step and leaf shrinkage of the boosted challenger."""

    iterations: int = 120
    leaves: int = 15
    step: float = 0.06
    l2: float = 8.0
    least_rows: int = 20
    bins: int = 255


@dataclass
class Tree:
    """Splits (node, feature, last bin of the left child) in order of growth; node k has children 2k, 2k + 1."""

    splits: list[tuple[int, int, int]] = field(default_factory=list)
    nodes: list[int] = field(default_factory=list)
    values: list[int] = field(default_factory=list)

    def add_to(self, prediction: np.ndarray, bins: np.ndarray) -> None:
        at = routed(bins, self.splits)
        order = np.argsort(self.nodes)
        prediction += np.asarray(self.values)[order][np.searchsorted(np.asarray(self.nodes)[order], at)]


@dataclass
class Model:
    """Bins and trees of one fold."""

    features: list[str]
    low: np.ndarray
    high: np.ndarray
    bounds: list[np.ndarray]
    base: int
    trees: list[Tree] = field(default_factory=list)

    @property
    def mean(self) -> float:
        """Mean of the training targets."""
        return self.base / SCALE

    def binned(self, values: np.ndarray) -> np.ndarray:
        """Bin of every value: bounds below its cell."""
        cell = cells(values, self.low, self.high)
        return np.stack([np.searchsorted(b, cell[:, k]) for k, b in enumerate(self.bounds)], 1).astype(np.uint8)

    def predict(self, values: np.ndarray) -> np.ndarray:
        bins = self.binned(values)
        out = np.full(len(bins), self.base, np.int64)
        for tree in self.trees:
            tree.add_to(out, bins)
        return out / SCALE


def cells(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Cell of every value between a feature's least and largest."""
    width = np.where(high > low, high - low, 1.0)
    return np.clip(np.floor((values - low) / width * CELLS), 0, CELLS - 1).astype(np.int64)


def routed(bins: np.ndarray, splits: list[tuple[int, int, int]]) -> np.ndarray:
    """Node of every row under splits in order of growth."""
    at = np.ones(len(bins), np.int64)
    for node, feature, last in splits:
        here = np.flatnonzero(at == node)
        at[here] = 2 * node + (bins[here, feature] > last)
    return at


def best_splits(n: np.ndarray, g: np.ndarray, p: Params) -> list[tuple[float, int, int] | None]:
    """(gain, feature, last left bin) of every node from histograms (nodes, features, bins).

    Ties go to the smaller feature, then to the smaller bin."""
    left_n, left_g = np.cumsum(n, 2), np.cumsum(g, 2)
    all_n, all_g = left_n[:, :, -1:], left_g[:, :, -1:]

    def score(gradient: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return (gradient / SCALE) ** 2 / (rows + p.l2)

    gain = score(left_g, left_n) + score(all_g - left_g, all_n - left_n) - score(all_g, all_n)
    gain = np.where((left_n >= p.least_rows) & (all_n - left_n >= p.least_rows), gain, -np.inf).reshape(len(n), -1)
    best = gain.argmax(1)
    return [(float(v), int(k) // n.shape[2], int(k) % n.shape[2]) if v > 0 else None for v, k in zip(gain[np.arange(len(n)), best], best, strict=True)]


class Growing:
    """A tree on its way: what is known of its nodes, and what the next level needs."""

    def __init__(self, p: Params) -> None:
        self.p = p
        self.known: dict[int, tuple[tuple[float, int, int] | None, int]] = {}  # split, value
        self.sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _grown(self) -> tuple[list[int], set[int]]:
        """Nodes split best first, and the leaves; stops at a leaf that is not known yet."""
        done: list[int] = []
        leaves = {1}
        while len(leaves) < self.p.leaves and all(k in self.known for k in leaves):
            able = [k for k in leaves if self.known[k][0]]
            if not able:
                break
            node = max(able, key=lambda k: (self.known[k][0][0], -k))
            done.append(node)
            leaves = leaves - {node} | {2 * node, 2 * node + 1}
        return done, leaves

    def wanted(self) -> set[int]:
        """Nodes whose histograms decide how the tree goes on; none when it is grown."""
        done, leaves = self._grown()
        if all(k in self.known for k in leaves):
            return set()
        able = sorted((k for k in leaves if k in self.known and self.known[k][0]), key=lambda k: (-self.known[k][0][0], k))
        ahead = {c for k in able[: self.p.leaves - len(leaves)] for c in (2 * k, 2 * k + 1)}
        return {k for k in leaves | ahead if k not in self.known}

    def asked(self) -> list[int]:
        """What a pass must count of the wanted nodes: the left child of every pair."""
        return sorted({k & ~1 or 1 for k in self.wanted()})

    def take(self, nodes: list[int], n: np.ndarray, g: np.ndarray) -> None:
        """Take in the histograms of the asked nodes; a right child has the rest of its parent."""
        rest = [k for k in nodes if k > 1]
        at = {k: i for i, k in enumerate(nodes)}
        right = [(self.sums[k // 2][0] - n[at[k]], self.sums[k // 2][1] - g[at[k]]) for k in rest]
        self.learn([*nodes, *(k + 1 for k in rest)], np.stack([*n, *(r for r, _ in right)]), np.stack([*g, *(r for _, r in right)]))

    def splits(self) -> list[tuple[int, int, int]]:
        """Splits of all known nodes, parents first."""
        return [(k, *self.known[k][0][1:]) for k in sorted(self.known) if self.known[k][0]]

    def learn(self, nodes: list[int], n: np.ndarray, g: np.ndarray) -> None:
        """Take in the histograms (nodes, features, bins) that were wanted."""
        rows, gradient = n[:, 0].sum(1), g[:, 0].sum(1)
        values = np.rint(-self.p.step * gradient / (rows + self.p.l2)).astype(np.int64)
        self.sums.update(zip(nodes, zip(n, g, strict=True), strict=True))
        self.known.update(zip(nodes, zip(best_splits(n, g, self.p), values.tolist(), strict=True), strict=True))

    def tree(self) -> Tree:
        done, leaves = self._grown()
        nodes = sorted(leaves)
        return Tree([(k, *self.known[k][0][1:]) for k in done], nodes, [self.known[k][1] for k in nodes])

    def next_root(self) -> tuple[np.ndarray, np.ndarray]:
        """Histograms of all rows once this tree is in the predictions."""
        _, leaves = self._grown()
        moved = [(n, g + self.known[k][1] * n) for k, (n, g) in ((k, self.sums[k]) for k in sorted(leaves))]
        return sum(n for n, _ in moved)[None], sum(g for _, g in moved)[None]


def _decoded(row, n_features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bins = np.frombuffer(row.bins, np.uint8).reshape(row.n, n_features)
    return bins, np.frombuffer(row.target, "<i8"), np.frombuffer(row.prediction, "<i8").copy()


def _histograms(n_features: int, trees: dict[int, list[Tree]], asked: dict[int, tuple[list, list[int]]]):
    """Per task: {fold: (rows, gradient sums) by asked node, feature and bin}."""

    def count(blocks: Iterator) -> Iterator[dict[int, bytes]]:
        held: dict[int, np.ndarray] = {}
        for row in blocks:
            if row.fold not in asked:
                continue
            splits, nodes = asked[row.fold]
            bins, target, prediction = _decoded(row, n_features)
            for tree in trees[row.fold]:
                tree.add_to(prediction, bins)
            at = routed(bins, splits)
            slot = np.minimum(np.searchsorted(nodes, at), len(nodes) - 1)
            here = np.flatnonzero(np.asarray(nodes)[slot] == at)
            key = ((slot[here, None] * n_features + np.arange(n_features)) * 256 + bins[here]).ravel()
            size = len(nodes) * n_features * 256
            sums = held.setdefault(row.fold, np.zeros((2, size)))
            sums[0] += np.bincount(key, minlength=size)
            sums[1] += np.bincount(key, np.repeat((prediction - target)[here], n_features), minlength=size)
        yield {fold: _packed(sums) for fold, sums in held.items()}

    return count


def _packed(sums: np.ndarray) -> bytes:
    """Whole numbers as compressed byte planes: most are small, so most planes are empty."""
    return zlib.compress(np.ascontiguousarray(sums.ravel().astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").ravel().astype(np.float64)


def _added(a: dict[int, bytes], b: dict[int, bytes]) -> dict[int, bytes]:
    """Sums of two tasks: whole numbers below 2**53, so the order does not matter."""
    return {
        fold: _packed(_unpacked(a[fold]) + _unpacked(b[fold])) if fold in a and fold in b else a.get(fold, b.get(fold)) for fold in a.keys() | b.keys()
    }


def _advanced(n_features: int, trees: dict[int, list[Tree]]):
    """Blocks with the given trees in their predictions."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples():
                bins, _, prediction = _decoded(row, n_features)
                for tree in trees[row.fold]:
                    tree.add_to(prediction, bins)
                out.append(prediction.tobytes())
            yield batch.assign(prediction=out)

    return add


def _blocks(models: dict[int, Model], features: list[str]):
    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list[pd.DataFrame]] = {}
        for batch in batches:
            for fold, rows in batch.groupby("fold"):
                held.setdefault(fold, []).append(rows)
                if sum(map(len, held[fold])) >= BLOCK:
                    yield pack(fold, held.pop(fold))
        for fold, rows in held.items():
            yield pack(fold, rows)

    def pack(fold: int, parts: list[pd.DataFrame]) -> pd.DataFrame:
        rows = pd.concat(parts)
        bins = models[fold].binned(rows[features].to_numpy(np.float64))
        start, target = np.full(len(rows), models[fold].base, "<i8"), rows["target"].to_numpy("<i8")
        return pd.DataFrame([{"fold": fold, "n": len(rows), "bins": bins.tobytes(), "target": target.tobytes(), "prediction": start.tobytes()}])

    return make


def feature_bins(rows: DataFrame, features: list[str], bins: int) -> dict[int, Model]:
    """Bins of every fold's features, from exact counts per cell (the same on any partitioning).

    A window runs over one feature's cells of one fold: ``CELLS`` rows at most."""
    ends = rows.groupBy("fold").agg(
        F.array(*(F.min(c).cast("double") for c in features)).alias("low"), F.array(*(F.max(c).cast("double") for c in features)).alias("high"),
        F.sum("target").alias("total"), F.count("*").alias("n"),
    ).collect()
    models = {
        r.fold: Model(features, np.array(r.low), np.array(r.high), [np.empty(0, np.int64)] * len(features), round(r.total / r.n)) for r in ends
    }

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for fold, part in batch.groupby("fold"):
                cell = cells(part[features].to_numpy(np.float64), models[fold].low, models[fold].high)
                for k in range(len(features)):
                    total[fold, k] = total.get((fold, k), 0) + np.bincount(cell[:, k], minlength=CELLS)
        for (fold, k), n in total.items():
            used = np.flatnonzero(n)
            yield pd.DataFrame({"fold": fold, "feature": k, "cell": used, "n": n[used]})

    counts = rows.select("fold", *features).mapInPandas(counted, "fold int, feature int, cell long, n long")
    counts = counts.groupBy("fold", "feature", "cell").agg(F.sum("n").alias("n"))
    key = Window.partitionBy("fold", "feature")
    upto = F.sum("n").over(key.orderBy("cell"))
    ranked = counts.withColumns({"upto": upto, "total": F.sum("n").over(key), "kinds": F.count("*").over(key)})
    # few distinct cells: each is a bin; else a bin ends where its share of the rows is full
    share = F.floor(F.col("upto") * bins / F.col("total"))
    before = F.floor((F.col("upto") - F.col("n")) * bins / F.col("total"))
    cut = ranked.where((F.col("upto") < F.col("total")) & ((F.col("kinds") <= bins) | (share > before)))
    for r in cut.groupBy("fold", "feature").agg(F.array_sort(F.collect_list("cell")).alias("cells")).collect():  # bins - 1 values each
        models[r.fold].bounds[r.feature] = np.array(r["cells"], np.int64)
    return models


def fit(rows: DataFrame, features: list[str], p: Params = Params()) -> dict[int, Model]:
    """A model per fold from (fold int, features, target); null features are not allowed."""
    if p.bins > 255:
        raise ValueError("at most 255 bins")
    rows = stored(rows.select(F.col("fold").cast("int").alias("fold"), *(F.col(c).cast("double").alias(c) for c in features), F.rint(F.col("target").cast("double") * SCALE).cast("long").alias("target")), "boost-rows")
    n = rows.count()
    if not n:
        raise ValueError("no training rows for the boosted trees")
    models = feature_bins(rows, features, p.bins)
    blocks = stored(rows.repartition(max(1, -(-n // BLOCK))).mapInPandas(_blocks(models, features), _BLOCKS), "boost-blocks")
    dropped(rows)
    pending: dict[int, list[Tree]] = {fold: [] for fold in models}
    growing: dict[int, Growing] = {}
    for k in range(p.iterations):
        last_trees, growing = growing, {fold: Growing(p) for fold in models}
        for fold, t in last_trees.items():
            growing[fold].learn([1], *t.next_root())
        while asked := {fold: (t.splits(), t.asked()) for fold, t in growing.items() if t.wanted()}:
            sums = blocks.rdd.mapPartitions(_histograms(len(features), pending, asked))
            sums = sums.reduce(_added) if sums.getNumPartitions() <= FEW else sums.treeReduce(_added)
            for fold, (_, nodes) in asked.items():
                n_, g_ = _unpacked(sums[fold]).reshape(2, len(nodes), len(features), 256)
                growing[fold].take(nodes, n_, g_)
        for fold, t in growing.items():
            tree = t.tree()
            models[fold].trees.append(tree)
            pending[fold].append(tree)
        if (k + 1) % STORE_EVERY == 0 and k + 1 < p.iterations:
            last, blocks = blocks, stored(blocks.mapInPandas(_advanced(len(features), pending), _BLOCKS), "boost-blocks")
            dropped(last)
            pending = {fold: [] for fold in models}
    dropped(blocks)
    return models
