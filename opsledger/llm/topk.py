"""Exact top-k inner products by norm-bucketed retrieval.

Candidates are grouped by length into buckets of similar norm and cut into bounded chunks. A
first look at one chunk of the longest vectors gives every query a score that its k-th best
cannot fall below. A bucket whose longest vector cannot reach that score is never visited. In
a chunk the score becomes a threshold on the cosine: below a limit only the length prunes;
above it the queries' strongest coordinates do, through the range that a vector so close must
lie in. What remains is verified by whole inner products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Vectors of a chunk, about; a task holds one chunk.
CHUNK_ROWS = 8192
#: Ratio of the lengths in a bucket, and the cosine from which coordinates prune.
BUCKET_RATIO, COORDINATES_FROM, FOCUS = 1.1, 0.5, 3


def whole_vectors(rows: DataFrame, scale: int) -> DataFrame:
    """vec_id, v (floor(scale * x) of each component), norm, of usable vectors.

    Null vectors and those with null or non-finite components are left out, as are null ids.
    """
    x = F.col("embedding")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    usable = rows.where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(~bad)
    v = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    square = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    return usable.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).withColumn("norm", F.sqrt(square))


def _bucket(norm: Column) -> Column:
    """Longer vectors have the smaller bucket number; all zero vectors share the last one."""
    return F.when(norm > 0, -F.floor(F.log(norm) / float(np.log(BUCKET_RATIO)))).otherwise(1 << 30).cast("int")


def _matrix(vectors: list) -> np.ndarray:
    """Rows as float64 if all products are exact in it, else as whole numbers."""
    m = np.array([np.asarray(v, np.int64) for v in vectors])
    top = float(np.abs(m).max(initial=0))
    return m.astype(np.float64) if top * top * max(1, m.shape[1]) < 2**53 else m


def _products(vectors: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products with ``q``, in the cheapest arithmetic that holds every partial sum."""
    largest = float(np.abs(vectors).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, q.size)
    if largest < 2**53:
        return (vectors.astype(np.float64, copy=False) @ q.astype(np.float64)).astype(np.int64)
    if largest < 2**62:
        return vectors.astype(np.int64) @ q.astype(np.int64)
    whole = vectors.astype(np.int64).astype(object) @ q.astype(np.int64).astype(object)
    if any(not -(2**63) <= x < 2**63 for x in whole):
        raise ValueError("a score does not fit a long")
    return whole.astype(np.int64)


class _Chunk:
    """Candidates of one chunk, by falling length, with sorted lists per coordinate on demand."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, norms: np.ndarray) -> None:
        order = np.lexsort((ids, -norms))
        self.ids, self.vectors, self.norms = ids[order], vectors[order], norms[order]
        with np.errstate(divide="ignore", invalid="ignore"):
            self.unit = np.where(self.norms[:, None] > 0, self.vectors / self.norms[:, None], 0.0)
        self.sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _coordinate(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.sorted:
            order = np.argsort(self.unit[:, f], kind="stable")
            self.sorted[f] = (order, self.unit[order, f])
        return self.sorted[f]

    def candidates(self, q: np.ndarray, q_norm: float, floor: float | None) -> np.ndarray | slice:
        """Rows that may score at least ``floor`` (none yet: all rows)."""
        if floor is None or floor <= 0 or not q_norm:
            return slice(None)
        # Lengths: only vectors of at least floor / |q| can reach it.
        long_enough = int(np.searchsorted(-self.norms, -(floor / q_norm) * (1 - 1e-9), "right"))
        cosine = floor / (q_norm * self.norms[0]) if self.norms[0] else 2.0
        if cosine < COORDINATES_FROM or not long_enough:
            return slice(0, long_enough)
        if cosine > 1 + 1e-9:
            return slice(0, 0)
        unit = q.astype(np.float64) / q_norm
        spread = np.sqrt(max(0.0, 1 - min(cosine, 1.0) ** 2))
        best = None
        for f in np.argsort(-np.abs(unit), kind="stable")[:FOCUS]:
            order, values = self._coordinate(int(f))
            side = spread * np.sqrt(max(0.0, 1 - unit[f] ** 2))
            # A cosine above the threshold may be larger than it: the range opens towards 1.
            low = unit[f] * cosine - side if unit[f] * cosine - side > -1 and -unit[f] < cosine else -1.0
            high = unit[f] * cosine + side if unit[f] < cosine else 1.0
            lo, hi = np.searchsorted(values, low - 1e-9, "left"), np.searchsorted(values, high + 1e-9, "right")
            if best is None or hi - lo < len(best):
                best = order[lo:hi]
        return np.sort(best[best < long_enough])

    def search(self, query_id: int, q: np.ndarray, q_norm: float, floor: float | None, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best k rows (ties: smaller id), none below ``floor``."""
        rows = self.candidates(q, q_norm, floor)
        ids, vectors = self.ids[rows], self.vectors[rows]
        score = _products(vectors, q)
        ok = ids != query_id
        if floor is not None:
            ok &= score >= floor
        ids, score = ids[ok], score[ok]
        if ids.size > 4 * k:
            least = np.partition(score, ids.size - k)[ids.size - k]
            ids, score = ids[score >= least], score[score >= least]
        order = np.lexsort((ids, -score))[:k]
        return ids[order], score[order]


def _search(k: int):
    """Rows sorted by chunk, candidates (role 0) before queries (role 1)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held, chunk = None, [], None
        for batch in batches:
            out = []
            for key, role, vid, v, norm, floor in zip(zip(batch["dim"], batch["bucket"], batch["chunk"]), batch["role"], batch["vec_id"], batch["v"], batch["norm"], batch["floor"]):
                if key != at:
                    at, held, chunk = key, [], None
                if role == 0:
                    held.append((vid, v, norm))
                    continue
                if not held:
                    continue
                if chunk is None:
                    chunk = _Chunk(np.array([h[0] for h in held], np.int64), _matrix([h[1] for h in held]), np.array([h[2] for h in held]))
                q = _matrix([v])[0]
                ids, score = chunk.search(vid, q, norm, None if np.isnan(floor) else floor, k)
                mark = _fingerprint(v)
                out.extend((vid, mark, i, s) for i, s in zip(ids.tolist(), score.tolist()))
            yield pd.DataFrame(out, columns=["query_id", "mark", "vec_id", "score"]).astype({"query_id": "int64", "mark": "int64", "vec_id": "int64", "score": "int64"})

    return run


def _fingerprint(v) -> int:
    return xxhash.xxh3_64_intdigest(np.asarray(v, np.int64).tobytes()) >> 1


def _best(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


_FOUND = "query_id long, mark long, vec_id long, score long"


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """Best ``k`` candidates of every query by integer inner product: query_id, rank, vec_id, score.

    ``vectors`` has vec_id and embedding; components become floor(scale * x). Queries are the
    rows where ``is_query`` (a condition on vec_id) holds; candidates are all rows with another
    vec_id and the same number of components. Ranks go by score, then smaller vec_id; a query
    with fewer candidates has fewer rows. Null vectors, null or non-finite components and null
    ids take no part. Repeated rows are candidates each; a repeated query row is one query
    (rows of one id with different vectors are ranked apart). Scores must fit a long. Empty
    tables give no rows. Other columns are ignored.
    """
    usable = whole_vectors(vectors, scale).withColumns({"dim": F.size("v"), "bucket": _bucket(F.col("norm"))})
    usable = stored(usable, "vectors")
    sizes = stored(usable.groupBy("dim", "bucket").agg(F.count("*").alias("n"), F.max("norm").alias("longest")), "buckets")
    sizes = sizes.withColumn("chunks", F.ceil(F.col("n") / CHUNK_ROWS).cast("int"))
    first = sizes.groupBy("dim").agg(F.min("bucket").alias("first"))
    # Buckets are ranges of the logarithm of a length: a few hundred rows at most per dimension.
    table = F.broadcast(sizes.select("dim", "bucket", "chunks"))
    dealt = usable.join(table, ["dim", "bucket"]).withColumn("chunk", F.pmod(F.xxhash64("vec_id", "v"), F.col("chunks")).cast("int"))
    members = dealt.select("dim", "bucket", "chunk", F.lit(0).alias("role"), "vec_id", "v", "norm", F.lit(None).cast("double").alias("floor"))
    queries = usable.where(is_query).select("vec_id", "v", "norm", "dim").distinct()

    def searched(chunks: DataFrame, asked: DataFrame) -> DataFrame:
        rows = chunks.union(asked.select("dim", "bucket", "chunk", F.lit(1).alias("role"), "vec_id", "v", "norm", "floor"))
        rows = rows.repartition("dim", "bucket", "chunk").sortWithinPartitions("dim", "bucket", "chunk", "role")
        return rows.mapInPandas(_search(k), _FOUND)

    opening = queries.join(F.broadcast(first), "dim").select("*", F.col("first").alias("bucket"), F.lit(0).alias("chunk"), F.lit(None).cast("double").alias("floor"))
    is_first = F.broadcast(first.select("dim", F.col("first").alias("bucket"), F.lit(0).alias("chunk")))
    seeded = stored(_best(searched(members.join(is_first, ["dim", "bucket", "chunk"], "left_semi"), opening), k).drop("rank"), "seeded")
    floors = seeded.groupBy("query_id", "mark").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= k)
    floors = floors.groupBy(F.col("query_id").alias("vec_id")).agg(F.min("least").cast("double").alias("floor"))
    asked = queries.join(floors, "vec_id", "left")
    visits = F.broadcast(sizes.select("dim", "bucket", "longest", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")))
    asked = asked.join(visits, "dim").where(F.col("floor").isNull() | (F.col("norm") * F.col("longest") * (1 + 1e-9) >= F.col("floor")))
    asked = asked.join(is_first, ["dim", "bucket", "chunk"], "left_anti")
    rest = searched(members.join(is_first, ["dim", "bucket", "chunk"], "left_anti"), asked)
    return _best(seeded.union(rest), k).select("query_id", "rank", "vec_id", "score")
