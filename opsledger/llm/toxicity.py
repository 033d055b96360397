"""Toxicity by a classifier chain: categories in order, each model fed by the earlier ones.

Every link is a logistic model over the presence of selected words and over the probabilities
of the links before it. While training, those probabilities come from models fitted on the
other folds, so a later link sees them as it will see them on new texts. A category is taught by
the toxic label together with a short seed list of its terms; the last link is the label
itself. Words are chosen by their evidence in a bounded, documented sample of labelled rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, stored

#: Categories in chain order with seed terms; texts in any language are judged by learned words.
CATEGORIES: dict[str, tuple[str, ...]] = {
    "insult": ("idiot", "moron", "clown", "loser", "fool", "stupid", "dumb"),
    "contempt": ("pathetic", "worthless", "disgusting", "useless", "ridiculous"),
    "dehumanising": ("scum", "trash", "vermin", "garbage", "filth"),
}
#: Upper-case letters to lower case, every other ASCII byte but letters to a blank.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
FOLDS = 4


def words_of(text: bytes | None) -> set[bytes]:
    """Distinct words: runs of ASCII letters (lower-cased) and non-ASCII bytes; null: none."""
    return set(text.translate(_FOLD).split()) if text else set()


def _evidence(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents per word and label, summed over a partition of the sample."""
    seen = {0: Counter(), 1: Counter()}
    for batch in batches:
        for text, label in zip(batch["text"], batch["toxic"]):
            seen[label].update(words_of(text))
    for label, c in seen.items():
        if c:
            yield pd.DataFrame({"word": list(c.keys()), "toxic": label, "n": list(c.values())})


def _present(index: dict[bytes, int], seeds: list[set[bytes]]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [words_of(t) for t in batch["text"]]
            at = [sorted(index[w] for w in s if w in index) for s in sets]
            targets = [[bool(s & seed) for seed in seeds] for s in sets]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "toxic": batch["toxic"], "weight": batch["weight"], "at": at, "targets": targets})

    return run


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float, rounds: int = 60) -> np.ndarray:
    """Weighted logistic regression by a fixed curvature bound: one factorisation, many steps.

    The last column of ``x`` is the constant, which is not penalised.
    """
    penalty = np.full(x.shape[1], l2)
    penalty[-1] = 1e-6
    bound = np.linalg.inv(0.25 * (x.T * weight) @ x + np.diag(penalty))
    w, ahead, t = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 1.0
    for _ in range(rounds):  # accelerated steps
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30)))
        new = ahead + bound @ (x.T @ (weight * (y - p)) - penalty * ahead)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead = new + (before - 1) / t * (new - w)
        w = new
    return w


def _probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))


def _squash(p: np.ndarray) -> np.ndarray:
    return np.log((p + 1e-3) / (1 - p + 1e-3)) / 4


def train_chain(x: np.ndarray, targets: np.ndarray, weight: np.ndarray, fold: np.ndarray, l2: float) -> list[np.ndarray]:
    """Coefficients of each link; column j of ``targets`` is the j-th category."""
    links, earlier = [], np.empty((len(x), 0))
    for j in range(targets.shape[1]):
        inputs = np.c_[x, earlier, np.ones(len(x))]
        links.append(_logistic(inputs, targets[:, j], weight, l2))
        out = np.empty(len(x))
        for k in range(FOLDS):
            own = fold == k
            if own.any():
                out[own] = _probability(inputs[own], _logistic(inputs[~own], targets[~own, j], weight[~own], l2))
        earlier = np.c_[earlier, _squash(out)]
    return links


def apply_chain(x: np.ndarray, links: list[np.ndarray]) -> np.ndarray:
    """Probability of every category of each row, in chain order."""
    out, earlier = [], np.empty((len(x), 0))
    for w in links:
        p = _probability(np.c_[x, earlier, np.ones(len(x))], w)
        out.append(p)
        earlier = np.c_[earlier, _squash(p)]
    return np.stack(out, 1) if out else np.empty((len(x), 0))


class Chain:
    """Selected words and trained links."""

    def __init__(self, names: list[str], index: dict[bytes, int], links: list[np.ndarray]) -> None:
        self.names, self.index, self.links = names, index, links

    def probabilities(self, texts) -> np.ndarray:
        if not self.links:
            return np.zeros((len(texts), len(self.names)))
        x = np.zeros((len(texts), len(self.index)))
        get = self.index.get
        for i, text in enumerate(texts):
            at = [j for w in words_of(text) if (j := get(w)) is not None]
            x[i, at] = 1.0
        return apply_chain(x, self.links)


def fit_chain(docs: DataFrame, labels: DataFrame, per_label: int = 3000, n_words: int = 200, least: int = 5, l2: float = 1.0, categories: dict[str, tuple[str, ...]] | None = None) -> Chain:
    """Train the chain on at most ``per_label`` labelled documents of each label.

    The sample takes the lowest hashes of the ids; weights restore the real shares. Ids with null,
    other or contradicting labels are left out. Without both labels the chain is empty.
    """
    categories = CATEGORIES if categories is None else categories
    names = [*categories, "toxic"]
    spark = docs.sparkSession
    sure = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("high")).where("toxic = high").drop("high")
    sizes = {r["toxic"]: r["n"] for r in sure.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Chain(names, {}, [])
    picked = None
    for label in (0, 1):
        some = sure.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label)
        some = some.withColumn("weight", F.lit(sizes[label] / min(per_label, sizes[label])))
        picked = some if picked is None else picked.union(some)
    bounded = F.broadcast(picked)  # at most 2 * per_label rows of 24 bytes
    rows = docs.where("doc_id IS NOT NULL").select("doc_id", F.col("text").cast("binary").alias("text")).join(bounded, "doc_id")
    sample = stored(rows.select("doc_id", "text", F.col("toxic").cast("long").alias("toxic"), "weight"), "labelled")
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return Chain(names, {}, [])
    counted = sample.mapInPandas(_evidence, "word binary, toxic long, n long").groupBy("word").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("b"))
    # Difference of the shares against its standard error.
    p, q = F.col("a") / float(n[1]), F.col("b") / float(n[0])
    z = F.abs(p - q) / F.sqrt((p * (1 - p)) / float(n[1]) + (q * (1 - q)) / float(n[0]) + 1e-6)
    chosen = counted.where(F.col("a") + F.col("b") >= least).select("word", z.alias("z")).orderBy(F.desc("z"), "word").limit(n_words).collect()
    index = {bytes(w): i for i, w in enumerate(sorted(bytes(r["word"]) for r in chosen))}
    seeds = [{s.encode() for s in terms} for terms in categories.values()]
    data = sample.mapInPandas(_present(index, seeds), "doc_id long, toxic long, weight double, at array<int>, targets array<boolean>").toPandas()
    data = data.sort_values(["doc_id", "toxic"], kind="stable")
    x = np.zeros((len(data), len(index)))
    for i, at in enumerate(data["at"]):
        x[i, np.asarray(at, np.int64)] = 1.0
    toxic = data["toxic"].to_numpy(float)
    targets = np.c_[np.array(data["targets"].tolist(), float).reshape(len(data), len(seeds)) * toxic[:, None], toxic]
    fold = np.arange(len(data)) % FOLDS
    return Chain(names, index, train_chain(x, targets, data["weight"].to_numpy(float), fold, l2))


def _judged(chain, threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.iloc[at : at + 512]
                p = chain.value.probabilities(part["text"].tolist())
                out = {c: part[c] for c in part.columns if c != "text"}
                yield pd.DataFrame(out | {f"p_{name}": p[:, j] for j, name in enumerate(chain.value.names)} | {"rejected": p[:, -1] >= threshold})

    return run


def judge_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **training) -> DataFrame:
    """Judge every whole text: doc_id, p_<category> in chain order, p_toxic, rejected.

    ``labels`` has doc_id and toxic (0 or 1). A text is rejected when the last link reaches
    ``threshold``. Null and empty texts have no words and get the base rate. Repeated rows are
    judged alike; null ids pass through. Without both labels all probabilities are 0 and nothing
    is rejected. Other columns are ignored. No shuffle: the chain (``n_words`` words) is
    broadcast.
    """
    chain = Shared(docs.sparkSession, fit_chain(docs, labels, **training))
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    schema = "doc_id string, " + ", ".join(f"p_{n} double" for n in chain.value.names) + ", rejected boolean"
    return rows.mapInPandas(_judged(chain, threshold), schema).withColumn("doc_id", F.col("doc_id").cast("long"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **training) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns, in no shuffle."""
    chain = Shared(docs.sparkSession, fit_chain(docs, labels, **training))

    @F.pandas_udf("boolean")
    def rejected(texts: pd.Series) -> pd.Series:
        out = [chain.value.probabilities(texts.iloc[i : i + 512].tolist())[:, -1] >= threshold for i in range(0, len(texts), 512)]
        return pd.Series(np.concatenate(out) if out else np.empty(0, bool))

    return docs.where(~rejected(F.col("text").cast("binary")))
