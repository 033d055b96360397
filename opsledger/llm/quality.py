"""Quality classifier: regularised quadratic discriminant over document statistics.

Each class is a Gaussian over transformed statistics of the whole text. Its covariance is
shrunk towards the pooled one and towards a sphere; the score is the difference of the two log
densities (Mahalanobis distances and determinants from cached Cholesky factors) and the
priors. Means and covariances come from distributed sums, so every labelled row that may be
learned from counts; the shrinkage is chosen by the loss on left-out folds.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, stored

FOLDS = 5
#: Towards the pooled covariance, towards a sphere, and the divisor of the log-odds.
SHRINK, ROUND, COOL = (0.05, 0.3, 0.7), (0.01, 0.1), (1.0, 3.0, 8.0)
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#$%&*@^~<>{}[]=+\\_`")] = True
_ENDS = (b".", b"!", b"?", b":", b";", b'"')


def _ratio(part: float, whole: float) -> float:
    """Log-odds of a share, finite at both ends."""
    share = part / whole if whole else 0.0
    return float(np.log((share + 1e-3) / (1 - share + 1e-3)))


def statistics(text: bytes | None) -> list[float]:
    """Transformed statistics of a whole text; null and empty texts give those of nothing."""
    raw = np.frombuffer(text or b"", np.uint8)
    n = raw.size
    count = np.bincount(raw, minlength=256)
    upper, lower, digits = int(count[65:91].sum()), int(count[97:123].sum()), int(count[48:58].sum())
    words = (text or b"").split()
    k = len(words)
    distinct = len(set(words))
    lines = (text or b"").split(b"\n")
    filled = [x for x in lines if x.strip()]
    length = np.fromiter(map(len, words), np.int64, k)
    pairs = len(set(zip(words, words[1:])))
    again = sum(a == b for a, b in zip(words, words[1:]))
    return [
        float(np.log1p(n)),
        float(np.log1p(k)),
        float(np.log1p(len(filled))),
        float(np.log1p(length.mean())) if k else 0.0,
        float(np.log1p(length.std())) if k else 0.0,
        float(np.log1p(k / max(1, len(filled)))),
        _ratio(upper, upper + lower),
        _ratio(upper + lower, n),
        _ratio(digits, n),
        _ratio(int(count[_SYMBOLS].sum()), n),
        _ratio(int(count[ord("|")]), n),
        _ratio(int(count[ord("!")] + count[ord("?")]), n),
        _ratio(int(count[ord(".")] + count[ord(",")]), n),
        _ratio(int(count[128:].sum()), n),
        _ratio(distinct, k),
        _ratio(pairs, k - 1),
        _ratio(again, k - 1),
        _ratio(len(set(filled)), len(filled)),
        _ratio(sum(x.rstrip().endswith(_ENDS) for x in filled), len(filled)),
        _ratio(int((length <= 3).sum()), k),
        _ratio(int((length >= 12).sum()), k),
    ]


N_STATS = len(statistics(None))


def _measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"doc_id": batch["doc_id"], "x": [np.array(statistics(t)).tobytes() for t in batch["text"]]})


def _rows(x: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(x), np.float64).reshape(-1, N_STATS)


def _sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Count, sums and sums of products of a partition's rows, per label and fold."""
    total: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        x = np.c_[np.ones(len(batch)), _rows(batch["x"])]
        for label, fold in set(zip(batch["label"], batch["fold"])):
            own = x[((batch["label"] == label) & (batch["fold"] == fold)).to_numpy()]
            total[label, fold] = total.get((label, fold), 0) + own.T @ own
    for (label, fold), m in total.items():
        yield pd.DataFrame({"label": label, "fold": fold, "at": np.arange(m.size), "v": m.ravel()})


class Discriminant:
    """Two Gaussians with shrunk covariances, ready to score.

    ``sums`` maps a label to its matrix of sums of products of (1, statistics).
    """

    def __init__(self, sums: dict[int, np.ndarray], shrink: float, round_: float, cool: float) -> None:
        n = {c: m[0, 0] for c, m in sums.items()}
        self.constant = None if len(n) == 2 and min(n.values()) > 1 else (float(next(iter(n))) if n else 0.5)
        if self.constant is not None:
            return
        mean = {c: m[0, 1:] / n[c] for c, m in sums.items()}
        cov = {c: m[1:, 1:] / n[c] - np.outer(mean[c], mean[c]) for c, m in sums.items()}
        total = sum(n.values())
        pooled = sum(n[c] / total * cov[c] for c in cov)
        self.scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
        self.parts, self.cool = {}, cool
        for c in cov:
            s = ((1 - shrink) * cov[c] + shrink * pooled) / np.outer(self.scale, self.scale)
            s = (1 - round_) * s + round_ * max(np.trace(s) / len(s), 1e-6) * np.eye(len(s))
            factor = np.linalg.cholesky(s + 1e-9 * np.eye(len(s)))
            # The inverse of the factor turns a distance into one product per batch.
            self.parts[c] = (mean[c], np.linalg.inv(factor), 2 * np.log(np.diag(factor)).sum(), np.log(n[c] / total))

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row."""
        if self.constant is not None:
            return np.full(len(x), self.constant)
        density = {}
        for c, (mean, inverse, logdet, _) in self.parts.items():
            z = ((x - mean) / self.scale) @ inverse.T
            density[c] = -0.5 * ((z * z).sum(1) + logdet)
        odds = (density[1] - density[0]) / self.cool + self.parts[1][3] - self.parts[0][3]
        return 1 / (1 + np.exp(-np.clip(odds, -60, 60)))


def fold_of(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def _losses(models):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(next(iter(models.value.values()))))
        for batch in batches:
            x, y, fold = _rows(batch["x"]), batch["label"].to_numpy(), batch["fold"].to_numpy()
            for k, candidates in models.value.items():
                own = fold == k
                if own.any():
                    for i, m in enumerate(candidates):
                        p = np.clip(m.score(x[own]), 1e-6, 1 - 1e-6)
                        total[i] -= np.log(np.where(y[own] == 1, p, 1 - p)).sum()
        yield pd.DataFrame({"at": np.arange(total.size), "v": total})

    return run


def fit(measured: DataFrame, labels: DataFrame) -> Discriminant:
    """Fit on rows whose fold is not 0. Sums per label and fold are all that the driver gets."""
    sure = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("high")).where("label = high")
    rows = measured.withColumn("fold", fold_of(F.col("doc_id"))).where("fold <> 0")
    rows = stored(rows.join(sure.select("doc_id", F.col("label").cast("long").alias("label")), "doc_id").select("x", "label", "fold"), "labelled")
    summed = rows.mapInPandas(_sums, "label long, fold long, at long, v double").groupBy("label", "fold", "at").agg(F.sum("v").alias("v")).orderBy("label", "fold", "at").toPandas()
    sums = {key: g["v"].to_numpy().reshape(N_STATS + 1, N_STATS + 1) for key, g in summed.groupby(["label", "fold"])}

    def without(fold: int | None) -> dict[int, np.ndarray]:
        return {c: sum(m for (d, f), m in sums.items() if d == c and f != fold) for c in {c for c, f in sums if f != fold}}

    grid = list(product(SHRINK, ROUND, COOL))
    models = {k: [Discriminant(without(k), *g) for g in grid] for k in sorted({f for _, f in sums})}
    if not models:
        return Discriminant({}, *grid[0])
    shared = Shared(measured.sparkSession, models)
    loss = rows.mapInPandas(_losses(shared), "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    best = min(loss, key=lambda r: (round(r["v"], 6), r["at"]))["at"]
    return Discriminant(without(None), *grid[best])


def _scored(model, threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            p = model.value.score(_rows(batch["x"])) if len(batch) else np.empty(0)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": p, "predicted": (p >= threshold).astype(np.int32)})

    return run


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Score every whole text of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    Learns from rows of ``labels`` (doc_id, quality 0 or 1) whose crc32 of the id as text is not
    0 modulo 5; ids with null, other or contradicting labels are not learned from. Only the
    text is an input of a score. Null and empty texts are scored by the statistics of nothing.
    Repeated rows are scored alike; a null id is scored, not held out. Without rows of both
    labels all scores are the only label's, or 0.5 without any. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    measured = stored(rows.mapInPandas(_measured, "doc_id string, x binary"), "statistics").withColumn("doc_id", F.col("doc_id").cast("long"))
    model = Shared(docs.sparkSession, fit(measured, labels))
    scored = measured.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(_scored(model, threshold), "doc_id string, score double, predicted int")
    scored = scored.withColumn("doc_id", F.col("doc_id").cast("long"))
    return scored.select("doc_id", F.coalesce(fold_of(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score", "predicted")
