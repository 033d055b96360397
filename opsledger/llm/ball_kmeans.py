"""Vector codes from ball k-means, in exact integers.

Components become floor(scale * x). A vector is cut into equal parts; each part position has its
own codebook. The parts of one entry form a ball around it. With squared distances as integers, a
part at distance d of its entry can only be as near to entry j if D(entry, j) <= 4 d: so

* only entries within four times the ball's squared radius are its neighbours,
* a part nearer than half the way to the nearest neighbour lies in the stable core and keeps its
  entry without another distance,
* the neighbours, ordered by distance, cut the rest of the ball into annular rings; a part is
  compared with the neighbours of its ring and those inside it, and with no others.

All entries beyond are strictly farther, so the nearest entry, ties to the smaller index, is exact.

Vectors are kept as blocks of rows (identifiers, integers and codes as bytes) in a stored table.
Each round reads the last table, assigns within tasks, writes the next one and deletes the one
before it; sums and counts of at most parts x entries rows per task meet in one aggregate, and
only the codebooks (parts x entries rows) come to the driver. A lost executor costs the tasks it
ran. A hot label or entry is only ever a row of sums.

Defined results:
* a vector that is null or holds a null or non-finite component is dropped;
* vectors of another length than the first kept one's (smallest id, then smallest vector) are
  dropped too; a length that the parts don't divide is filled up with zeros;
* a null id sorts last; repeated rows each count and get equal codes; equal entries: the smaller
  index takes all their parts, the other stays;
* fewer vectors than entries: as many entries as vectors; empty table: empty result;
* components beyond 2**26 are computed as Python integers; an error or sum beyond 63 bits is an
  ``ArithmeticException``/``OverflowError``, never a wrong number;
* other columns of the input are not kept (ids are); clashing names don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from math import floor

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsledger.functions.semantics import broadcast_if_small

from .common import Shared, dropped, stored

#: Vectors of a block.
BLOCK = 4096
#: Neighbours that one matrix product compares; rings are cut at multiples of it.
RING = 16
_BLOCKS = "n int, ids binary, missing binary, labels array<string>, wide boolean, vectors binary, codes binary"


@dataclass(frozen=True)
class Codebooks:
    """Entries of every part: array (parts, entries, width), int64 or Python integers."""

    entries: np.ndarray

    def between(self, part: int) -> np.ndarray:
        return squared(self.entries[part], self.entries[part])

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _exact(*arrays: np.ndarray) -> bool:
    """Whether squared distances and their terms fit into the 53 bits of a double."""
    most = max((int(np.abs(a).max()) for a in arrays if a.size), default=0)
    return 4 * max(arrays[0].shape[-1], 1) * most * most < 1 << 52


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x and y, exact."""
    if x.dtype != object and y.dtype != object and _exact(x, y):
        a, b = x.astype(np.float64), y.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    a, b = x.astype(object), y.astype(object)
    return np.array([[int(((p - q) ** 2).sum()) if p.size else 0 for q in b] for p in a], dtype=object).reshape(len(a), len(b))


def own_distance(x: np.ndarray, entries: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Squared distance of every row to the entry it has."""
    if x.dtype != object and entries.dtype != object and _exact(x, entries):
        gap = x - entries[code]
        return (gap * gap).sum(1)
    gap = x.astype(object) - entries.astype(object)[code]
    return (gap * gap).sum(1) if gap.shape[1] else np.zeros(len(x), object)


def first_assignment(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Nearest entry of every row without an earlier one, ties to the smaller index."""
    out = np.empty(len(x), np.int64)
    for at in range(0, len(x), BLOCK):
        out[at : at + BLOCK] = squared(x[at : at + BLOCK], entries).argmin(1)
    return out


def reassign(x: np.ndarray, code: np.ndarray, entries: np.ndarray, between: np.ndarray) -> tuple[np.ndarray, int]:
    """Nearest entry of every row, from the entry it had; and how many distances that took."""
    out, d = code.copy(), own_distance(x, entries, code)
    compared = len(x)
    order = np.lexsort((d, code))
    balls, starts = np.unique(code[order], return_index=True)
    for ball, rows in zip(balls, np.split(order, starts[1:]), strict=True):
        reach = 4 * d[rows]
        gaps = between[ball]
        near = np.flatnonzero(gaps <= reach[-1])
        near = near[near != ball]
        if not near.size:
            continue
        near = near[np.argsort(gaps[near], kind="stable")]
        ring = np.searchsorted(gaps[near], reach, side="right")
        at = int(np.searchsorted(ring, 1))
        while at < rows.size:
            most = min(-(-int(ring[at]) // RING) * RING, near.size)
            end = int(np.searchsorted(ring, most, side="right"))
            here, rivals = rows[at:end], near[:most]
            found = squared(x[here], entries[rivals])
            compared += found.size
            lowest = found.min(1)
            first = np.where(found == lowest[:, None], rivals[None, :], len(entries)).min(1)
            moves = (lowest < d[here]) | ((lowest == d[here]) & (first < ball))
            out[here[moves]] = first[moves]
            at = end
    return out, compared


def _unpacked(wide: bool, raw: bytes, n: int) -> np.ndarray:
    """The integers of a block, one row per vector."""
    if not n:
        return np.empty((0, 0), np.int64)
    if not wide:
        return np.frombuffer(raw, "<i4").astype(np.int64).reshape(n, -1)
    return np.array([int(v) for v in raw.decode().split(",") if v], dtype=object).reshape(n, -1)


def _packed(x: np.ndarray) -> tuple[bool, bytes]:
    """Integers as 32 bits where all fit, else as text."""
    if x.dtype != object:
        return False, x.astype("<i4").tobytes()
    return True, ",".join(map(str, x.ravel().tolist())).encode()


def floors(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x); Python integers when one is beyond 2**26."""
    x = np.floor(vectors * scale) if scale & (scale - 1) == 0 else np.floor(vectors.astype(np.float64) * scale)
    if np.isfinite(x).all() and (not x.size or np.abs(x).max() <= 1 << 26):
        return x.astype(np.int64)
    return np.array([floor(Fraction(v) * scale) for v in vectors.ravel().tolist()], dtype=object).reshape(vectors.shape)


def _blocks(scale: int, parts: int, length: int):
    """Rows (id, label, vector) as blocks without codes."""
    width = -(-length // parts) * parts

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        x = np.zeros((len(rows), width))
        if length:
            x[:, :length] = np.stack(rows["vector"].to_numpy())
        wide, raw = _packed(floors(x, scale))
        ids, missing = rows["id"].to_numpy("<i8").tobytes(), rows["missing"].to_numpy(np.uint8).tobytes()
        labels = [None if v is None else str(v) for v in rows["label"]]
        return pd.DataFrame([{"n": len(rows), "ids": ids, "missing": missing, "labels": labels, "wide": wide, "vectors": raw, "codes": b""}])

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n >= BLOCK:
                rows = pd.concat(held)
                for at in range(0, n - n % BLOCK, BLOCK):
                    yield pack(rows.iloc[at : at + BLOCK])
                held, n = [rows.iloc[n - n % BLOCK :]], n % BLOCK
        if n:
            yield pack(pd.concat(held))

    return make


def _assigned(x: np.ndarray, codes: bytes, books: Codebooks, betweens: list[np.ndarray]) -> np.ndarray:
    """Codes (rows, parts) of a block: from its last codes, or anew where it has none."""
    parts, width = books.entries.shape[0], books.entries.shape[2]
    out = np.empty((len(x), parts), np.int64)
    last = np.frombuffer(codes, "<u2").reshape(len(x), parts).astype(np.int64) if codes else None
    for p in range(parts):
        part = x[:, p * width : (p + 1) * width]
        out[:, p] = first_assignment(part, books.entries[p]) if last is None else reassign(part, last[:, p], books.entries[p], betweens[p])[0]
    return out


def _round(shared: Shared):
    """Blocks with the codes of the codebooks given."""

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        books: Codebooks = shared.value
        betweens = [books.between(p) for p in range(len(books.entries))]
        for batch in batches:
            codes = []
            for row in batch.itertuples():
                x = _unpacked(row.wide, row.vectors, row.n)
                codes.append(_assigned(x, row.codes, books, betweens).astype("<u2").tobytes())
            yield batch.assign(codes=codes)

    return step


def _sums(parts: int, entries: int):
    """Per task: (part, entry, n, sums) of the parts that each entry has."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[tuple[int, int], list] = {}
        for batch in batches:
            for row in batch.itertuples():
                x = _unpacked(row.wide, row.vectors, row.n)
                codes = np.frombuffer(row.codes, "<u2").reshape(len(x), parts)
                width = x.shape[1] // parts
                for p in range(parts):
                    order = np.argsort(codes[:, p], kind="stable")
                    used, start = np.unique(codes[order, p], return_index=True)
                    sums = np.add.reduceat(x[order, p * width : (p + 1) * width], start, axis=0) if width else np.empty((used.size, 0), np.int64)
                    for e, n, s in zip(used.tolist(), np.diff(np.append(start, len(x))).tolist(), sums.astype(object), strict=True):
                        was = total.setdefault((p, e), [0, 0])
                        was[0] += n
                        was[1] = was[1] + s
        rows = [(p, e, n, [int(v) for v in s]) for (p, e), (n, s) in total.items()]
        for _, _, _, s in rows:
            if any(abs(v) >= 1 << 63 for v in s):
                raise OverflowError("a sum of components is beyond 63 bits")
        yield pd.DataFrame(rows, columns=["part", "entry", "n", "sums"])

    return add


def _updated(books: Codebooks, blocks: DataFrame) -> Codebooks:
    """Each entry as the floor of its parts' mean; unused entries stay."""
    parts, size, width = books.entries.shape
    rows = blocks.mapInPandas(_sums(parts, size), "part int, entry int, n long, sums array<long>")
    means = rows.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("sums")[i]) for i in range(width))).alias("sums"))
    entries = books.entries.astype(object)
    for row in means.toLocalIterator():
        entries[row.part, row.entry] = [s // row.n for s in row.sums]
    return Codebooks(_narrow(entries))


def _narrow(entries: np.ndarray) -> np.ndarray:
    most = max((abs(v) for v in entries.ravel().tolist()), default=0)
    return entries.astype(np.int64) if most <= 1 << 26 else entries


def _codes(shared: Shared):
    """Final rows (id, label, code, error) of every block."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        books: Codebooks = shared.value
        parts, size, width = books.entries.shape
        digits = 2 if size <= 256 else 4
        text = np.array([f"{e:0{digits}x}" for e in range(max(size, 1))])
        for batch in batches:
            for row in batch.itertuples():
                x = _unpacked(row.wide, row.vectors, row.n)
                codes = np.frombuffer(row.codes, "<u2").reshape(len(x), parts).astype(np.int64)
                error = np.zeros(len(x), object)
                code = np.full(len(x), "", f"<U{digits * parts}")
                for p in range(parts):
                    error = error + own_distance(x[:, p * width : (p + 1) * width], books.entries[p], codes[:, p])
                    code = np.char.add(code, text[codes[:, p]])
                errors = [int(v) for v in error]
                if errors and max(errors) >= 1 << 63:
                    raise OverflowError("an error is beyond 63 bits")
                yield pd.DataFrame({"vec_id": pd.arrays.IntegerArray(np.frombuffer(row.ids, "<i8").astype(np.int64), np.frombuffer(row.missing, np.uint8).astype(bool)), "label": list(row.labels), "code": code, "error": errors})

    return read


@dataclass(frozen=True)
class Fitted:
    """Trained codebooks and the stored blocks that hold every vector's codes."""

    books: Codebooks
    blocks: DataFrame

    def rows(self) -> DataFrame:
        """vec_id, label (as text), code, error of every kept vector."""
        shared = Shared(self.blocks.sparkSession, self.books)
        return self.blocks.mapInPandas(_codes(shared), "vec_id long, label string, code string, error long")


def usable(vectors: DataFrame, vector_col: str) -> DataFrame:
    """Rows whose vector is there and holds only finite components."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(v.isNotNull() & ~F.coalesce(bad, F.lit(False)))


def fit(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label", parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> Fitted:
    """Codebooks after ``rounds`` rounds and every vector's codes under them."""
    spark = vectors.sparkSession
    if not 1 <= entries <= 1 << 16:
        raise ValueError("a codebook has 1 to 65536 entries")
    label = F.col(label_col).cast("string") if label_col else F.lit(None).cast("string")
    key = F.col(id_col).cast("long")
    rows = usable(vectors, vector_col).select(F.coalesce(key, F.lit(0)).alias("id"), key.isNull().alias("missing"), label.alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    order = (F.col("missing"), F.col("id"), F.col("vector"))
    first = rows.orderBy(*order).select("vector").limit(1).collect()
    length = len(first[0].vector) if first else 0
    rows = rows.where(F.size("vector") == length)
    seeds = [r.vector for r in rows.orderBy(*order).select("vector").limit(entries).collect()]
    width = -(-length // parts)
    x = np.zeros((len(seeds), width * parts))
    if length and seeds:
        x[:, :length] = np.array(seeds, np.float64)
    books = Codebooks(_narrow(floors(x, scale).reshape(len(seeds), parts, width).transpose(1, 0, 2).astype(object)))
    blocks = stored(rows.mapInPandas(_blocks(scale, parts, length), _BLOCKS), "ball-blocks")
    for r in range(rounds + 1):
        last, blocks = blocks, stored(blocks.mapInPandas(_round(Shared(spark, books)), _BLOCKS), f"ball-round{r}")
        dropped(last)
        if r < rounds:
            books = _updated(books, blocks)
    return Fitted(books, blocks)


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", **how) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every kept vector."""
    fitted = fit(vectors, id_col, vector_col, label_col, **how)
    rows = stored(fitted.rows(), "ball-rows")
    dropped(fitted.blocks)
    totals = stored(rows.groupBy("label").agg(F.sum("error").alias("label_error")), "ball-labels")
    out = rows.alias("r").join(broadcast_if_small(totals).alias("t"), F.col("r.label").eqNullSafe(F.col("t.label")))
    return out.select("r.vec_id", "r.code", "r.error", "t.label_error", F.lit(fitted.books.digest()).alias("codebooks_sha256"))
