"""Near-duplicate vectors through an inverted multi-index.

Two codebooks, one for each half of a vector, make a grid of cells. A vector lies in the cell of
its nearest centroids. How far the other cells are is bounded from below by the distance to
the border between two centroids; the multi-sequence traversal visits cells in that order, half
by half, up to the radius that holds the target recall. Pairs met in a cell are verified by
their cosine in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, stored
from .components import components

#: Members a task holds of a cell; larger cells are split and visited part by part.
CHUNK_ROWS = 2048


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances to all centroids."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centroids.T + (centroids * centroids).sum(1)[None, :], 0)


def train_codebook(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k-means with farthest-first seeds over every row given; fewer distinct rows, fewer centroids."""
    distinct = np.unique(x, axis=0)
    if len(distinct) <= k:
        return distinct
    seeds, far = [0], _nearest(distinct, distinct[:1])[:, 0]
    rng = np.random.default_rng(7)
    for _ in range(k - 1):
        at = int(rng.choice(len(distinct), p=far / far.sum()))
        seeds.append(at)
        far = np.minimum(far, _nearest(distinct, distinct[at : at + 1])[:, 0])
    c = distinct[seeds]
    for _ in range(rounds):
        own = _nearest(x, c).argmin(1)
        n = np.bincount(own, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


class MultiIndex:
    """Codebooks of both halves, cell of a vector, and the cells near it."""

    def __init__(self, sample: np.ndarray, per_half: int) -> None:
        self.dim = sample.shape[1]
        self.cut = (self.dim + 1) // 2
        self.books = [train_codebook(sample[:, : self.cut], per_half), train_codebook(sample[:, self.cut :], per_half)]
        self.apart = [np.sqrt(_nearest(b, b)) for b in self.books]

    def _half(self, x: np.ndarray, h: int) -> tuple[np.ndarray, np.ndarray]:
        """Own centroid, and for every centroid how far at least its region is, squared."""
        d = _nearest(x, self.books[h])
        own = d.argmin(1)
        apart = self.apart[h][own]
        with np.errstate(divide="ignore", invalid="ignore"):
            bound = np.where(apart > 0, np.maximum(d - d[np.arange(len(x)), own][:, None], 0) / (2 * apart), 0.0)
        return own, bound * bound

    def cells(self, x: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Own cell of each row; (row, cell) of all further cells within the radius."""
        width = len(self.books[1])
        (own_a, far_a), (own_b, far_b) = self._half(x[:, : self.cut], 0), self._half(x[:, self.cut :], 1)
        own = own_a * width + own_b
        order_a, order_b = far_a.argsort(1, kind="stable"), far_b.argsort(1, kind="stable")
        near_a, near_b = np.take_along_axis(far_a, order_a, 1), np.take_along_axis(far_b, order_b, 1)
        limit = radius * radius * (1 + 1e-9) + 1e-12
        rows, cells = [], []
        for step in range(near_a.shape[1]):  # the first sequence; the second goes as far as the sum allows
            left = limit - near_a[:, step]
            if (left < 0).all():
                break
            many = (near_b <= left[:, None]).sum(1)
            many[left < 0] = 0
            row = np.repeat(np.arange(len(x)), many)
            place = np.arange(row.size) - np.repeat(np.cumsum(many) - many, many)
            rows.append(row)
            cells.append(order_a[row, step] * width + order_b[row, place])
        row, cell = np.concatenate(rows), np.concatenate(cells)
        other = cell != own[row]
        return own, row[other], cell[other]


def _units(vectors) -> tuple[np.ndarray, np.ndarray]:
    """Usable rows (finite, not zero) of a column of vectors of one length, as unit rows."""
    m = np.array([np.asarray(v, np.float64) for v in vectors])
    norm = np.sqrt((m * m).sum(1))
    return m / norm[:, None], norm


def usable_vectors(rows: DataFrame) -> DataFrame:
    """Vectors that may link: label and id known, finite, not zero; equal ones are one row.

    rep (smallest vec_id), label, dim, embedding, weight (how many rows).
    """
    x = F.col("embedding")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    zero = ~F.exists(x, lambda c: c != 0)
    some = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(~bad).where(~zero)
    some = some.select("vec_id", "label", F.transform(x, lambda c: c.cast("double")).alias("embedding"))
    return some.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight")).withColumn("dim", F.size("embedding"))


_PLACED = "rep long, label {label}, dim int, weight long, embedding array<double>, cell long, own boolean"


def _cells(index, radius: float):
    """Each vector once in its own cell, and once for every cell of a higher number near it.

    A pair in two cells is met from the lower one. Vectors of another length than the index's
    share one cell.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = index.value
        for batch in batches:
            for dim, part in batch.groupby("dim", sort=False):
                for lo in range(0, len(part), 1024):
                    some = part.iloc[lo : lo + 1024].reset_index(drop=True)
                    at = np.arange(len(some))
                    if model is not None and dim == model.dim:
                        own, row, cell = model.cells(_units(some["embedding"])[0], radius)
                        up = cell > own[row]
                        row, cell = row[up], cell[up]
                    else:
                        own, row, cell = np.zeros(len(some), np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
                    out = some.iloc[np.r_[at, row]]
                    yield out.assign(cell=np.r_[own, cell], own=np.arange(len(out)) < len(at))

    return run


def _roots(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Smallest index that each of ``size`` nodes reaches over the links (a, b)."""
    root = np.arange(size)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _verify(cosine: float):
    """Links met in sorted (cell chunk, members before probes) rows, as counts and spanning edges."""

    def found(ids, weights, i, j) -> pd.DataFrame:
        """Rows of (node, root, n): links counted with the weight of the other end."""
        n = np.bincount(i, weights[j], ids.size) + np.bincount(j, weights[i], ids.size)
        root = _roots(i, j, ids.size)
        at = np.flatnonzero(n)
        return pd.DataFrame({"node": ids[at], "root": ids[root[at]], "n": n[at].astype(np.int64)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, members = None, None
        rows: list[pd.DataFrame] = []

        def close():
            x, _ = _units(pd.concat(rows)["embedding"])
            ids = np.concatenate([r["rep"].to_numpy() for r in rows])
            return ids, np.concatenate([r["weight"].to_numpy(float) for r in rows]), x

        def inside():
            ids, weights, x = members
            i, j = np.nonzero(np.triu(x @ x.T >= cosine, 1))
            if i.size:
                yield found(ids, weights, i, j)

        for batch in batches:
            for now, part in batch.groupby(["label", "dim", "cell", "chunk"], sort=False):
                if now != key:
                    if rows and members is None:
                        members = close()
                        yield from inside()
                    key, members, rows = now, None, []
                own = part[part["role"] == 0]
                if len(own):
                    rows.append(own)
                probes = part[part["role"] == 1]
                if not len(probes) or not rows:
                    continue
                if members is None:
                    members = close()
                    yield from inside()
                ids, weights, x = members
                for lo in range(0, len(probes), 2048):
                    some = probes.iloc[lo : lo + 2048]
                    y, _ = _units(some["embedding"])
                    i, j = np.nonzero(y @ x.T >= cosine)
                    if i.size:
                        yield found(np.r_[ids, some["rep"].to_numpy()], np.r_[weights, some["weight"].to_numpy(float)], j, ids.size + i)
        if rows and members is None:
            members = close()
            yield from inside()

    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.98, sample: int = 20_000, per_cell: int = 64, recall: float = 1.0) -> DataFrame:
    """Link vectors of one label by cosine: vec_id, n_links, component_id, kept, a row per row.

    ``vectors`` has vec_id, embedding, label. Links join rows with equal labels and as many
    components whose cosine (double precision) is at least ``cosine``. n_links counts the other
    rows linked directly; component_id is the smallest vec_id reachable; kept marks it. Vectors
    that are null, zero, of no components or hold null or non-finite components, and rows without
    label or id, have 0 links and their own component. Equal vectors (repeated rows too) link
    with each other as one class. Empty tables give no rows; other columns are ignored.

    The codebooks are fitted on at most ``sample`` vectors (lowest hashes); every vector is
    indexed. With ``recall`` 1 the traversal's radius is the largest distance of a link, so none
    is missed; below it the radius shrinks to what that share of random directions stays in.
    """
    spark = vectors.sparkSession
    rows = stored(usable_vectors(vectors), "vectors")
    n = rows.count()
    common = rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    model = None
    if common is not None:
        picked = rows.where(F.col("dim") == common["dim"]).orderBy(F.xxhash64("rep", F.lit(3)), "rep").limit(sample).select("embedding").toPandas()
        labels = max(1, rows.select("label").distinct().count())
        # Cells of one label hold about per_cell vectors.
        per_half = int(np.clip(np.sqrt(n / labels / per_cell), 1, 1024))
        model = MultiIndex(_units(picked["embedding"])[0], per_half)
    radius = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + 1e-9
    if recall < 1 and model is not None:
        from statistics import NormalDist

        radius *= min(1.0, NormalDist().inv_cdf((1 + recall) / 2) * np.sqrt(2 / model.dim))
    index = Shared(spark, model)

    kind = rows.schema["label"].dataType.simpleString()
    placed = rows.select("rep", "label", "dim", "weight", "embedding").mapInPandas(_cells(index, radius), _PLACED.format(label=kind))
    # Large cells are cut into chunks: a member lies in one, and visits the later ones; what
    # comes from other cells visits all. How many chunks a cell has is joined, not broadcast.
    at_home = rows.select("rep", "label", "dim", "weight", "embedding").mapInPandas(_cells(index, 0.0), _PLACED.format(label=kind)).where("own")
    large = at_home.groupBy("label", "dim", "cell").agg(F.ceil(F.count("*") / CHUNK_ROWS).cast("int").alias("chunks")).where(F.col("chunks") > 1)
    split = placed.join(large, ["label", "dim", "cell"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    split = split.withColumn("home", F.pmod(F.xxhash64("rep", F.lit(11)), F.col("chunks")).cast("int"))
    visit = lambda role, chunk: F.struct(F.lit(role).alias("role"), chunk.cast("int").alias("chunk"))
    parts = F.sequence(F.lit(0), F.col("chunks") - 1)
    mine = F.concat(F.array(visit(0, F.col("home"))), F.transform(F.filter(parts, lambda c: c > F.col("home")), lambda c: visit(1, c)))
    visits = split.withColumn("to", F.explode(F.when(F.col("own"), mine).otherwise(F.transform(parts, lambda c: visit(1, c)))))
    visits = visits.select("label", "dim", "cell", F.col("to.chunk").alias("chunk"), F.col("to.role").alias("role"), "rep", "weight", "embedding")
    dealt = visits.repartition("label", "dim", "cell", "chunk").sortWithinPartitions("label", "dim", "cell", "chunk", "role")
    links = stored(dealt.mapInPandas(_verify(cosine), "node long, root long, n long"), "links")

    reached = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    direct = links.groupBy("node").agg(F.sum("n").alias("n"))
    x = F.transform("embedding", lambda c: c.cast("double"))
    whole = rows.join(direct, F.col("rep") == F.col("node"), "left").drop("node").join(reached, F.col("rep") == F.col("node"), "left")
    classes = whole.select("label", "embedding", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    keyed = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", x.alias("embedding"))
    out = keyed.join(classes, ["label", "embedding"], "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    out = out.select("vec_id", F.when(F.col("vec_id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
