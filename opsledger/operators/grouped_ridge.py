"""Ridge regression with own coefficients per group, in one path for any number of groups.

The design has a few common features and, for every group, the same inner features switched on
by the group (indicator, indicator x weekend, ...). Its normal equations are arrow-shaped: one
small block per group, one common block, nothing between groups. Each group's moments
are one distributed aggregate; eliminating the group blocks leaves a system of the common
features only, which the driver solves; the group coefficients follow from it, group by group,
on the executors. No column per group exists and nothing that grows with the groups is collected.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# block arithmetic travels with its tasks: executors need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class GroupedFit:
    """Raw (unscaled) coefficients of one label; ``groups`` has the group key and ``weights``."""

    group: str
    inner: list[str]
    common: dict[str, float]
    intercept: float
    groups: DataFrame

    def predict(self, df: DataFrame, inner: dict[str, Column], common: dict[str, Column], out: str, also: float = 0.0) -> DataFrame:
        """Add ``out``: the linear predictor over the given features (a subset may be given)."""
        value = F.lit(self.intercept + also)
        for name, c in common.items():
            value = value + c * F.lit(self.common[name])
        for i, name in enumerate(self.inner):
            value = value + F.coalesce(F.col("_w")[i], F.lit(0.0)) * inner[name]
        weights = self.groups.select(self.group, F.col("weights").alias("_w"))
        return df.join(weights, self.group, "left").withColumn(out, value).drop("_w")


def _blocks(m: np.ndarray, k: int, p: int, n: float, alpha: float, scaled: bool):
    """Penalised group block, its coupling to (1, common) and its right-hand sides."""
    common = [0, *range(k, k + p)]
    b = m[:k, :k].copy()
    if scaled:
        share = m[0, :k] / n
        variance = np.diag(m)[:k] / n - share * share
        penalty = np.where(variance > 1e-15, variance, 1.0)
    else:
        penalty = np.ones(k)
    b[np.diag_indices(k)] += alpha * penalty
    return b, m[:k][:, common], m[:k, k + p :]


def fit_grouped(df: DataFrame, group: str, inner: dict[str, Column], common: dict[str, Column], labels: dict[str, Column], alpha: float, scaled: bool = True) -> dict[str, GroupedFit]:
    """Fit every label; the first inner feature must be the constant 1.

    The intercept is not penalised. With ``scaled`` the penalty acts on coefficients of
    population-standardised features (zero variance counts as scale 1), else on raw ones.
    """
    z = [*inner.values(), *common.values(), *labels.values()]
    k, p, q, width = len(inner), len(common), len(labels), len(z)
    rows = df.select(group, *(c.cast("double").alias(f"z{i}") for i, c in enumerate(z)))
    upper = [(i, j) for i in range(width) for j in range(i, width)]
    sums = [F.sum(F.col(f"z{i}") * F.col(f"z{j}")).alias(f"m{i}_{j}") for i, j in upper]
    moments = rows.groupBy(group).agg(*sums).select(group, F.array(*(f"m{i}_{j}" for i, j in upper)).alias("m")).cache()
    place = np.array(upper).T

    def matrix(m) -> np.ndarray:
        out = np.zeros((width, width))
        out[place[0], place[1]] = m
        return out + np.triu(out, 1).T

    added = moments.select(F.posexplode("m").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).toPandas()
    flat = np.zeros(len(upper))
    flat[added["at"].to_numpy(np.int64)] = added["v"].to_numpy(float)
    total = matrix(flat)
    n = total[0, 0]
    if not n:
        return {}
    size = (p + 1) * (p + 1 + q)

    def eliminated(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = np.zeros((p + 1, p + 1 + q))
        for batch in batches:
            for m in batch["m"]:
                b, c, r = _blocks(matrix(m), k, p, n, alpha, scaled)
                out += c.T @ np.linalg.solve(b, np.c_[c, r])
        yield pd.DataFrame({"at": np.arange(size), "v": out.ravel()})

    gone = moments.select("m").mapInPandas(eliminated, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).toPandas()
    gone = gone.sort_values("at")["v"].to_numpy(float).reshape(p + 1, -1)
    at = [0, *range(k, k + p)]
    left, right = total[np.ix_(at, at)] - gone[:, : p + 1], total[np.ix_(at, range(k + p, width))] - gone[:, p + 1 :]
    variance = np.diag(total)[k : k + p] / n - (total[0, k : k + p] / n) ** 2
    penalty = np.where(variance > 1e-15, variance, 1.0) if scaled else np.ones(p)
    left[np.diag_indices(p + 1)] += np.r_[0.0, alpha * penalty]
    solved = np.linalg.solve(left, right)

    kind = df.schema[group].dataType.simpleString()

    def back(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for m in batch["m"]:
                b, c, r = _blocks(matrix(m), k, p, n, alpha, scaled)
                out.append(np.linalg.solve(b, r - c @ solved).T.ravel().tolist())
            yield pd.DataFrame({group: batch[group], "w": out})

    weights = moments.mapInPandas(back, f"{group} {kind}, w array<double>")
    return {
        label: GroupedFit(
            group, list(inner), dict(zip(common, solved[1:, i].tolist())), float(solved[0, i]),
            weights.select(group, F.slice("w", 1 + i * k, k).alias("weights")),
        )
        for i, label in enumerate(labels)
    }
