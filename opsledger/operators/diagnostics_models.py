"""Model-based diagnostics: site clustering, residualised staffing association and
its site-cluster bootstrap (D01, D03, D04, K04).

* D01: k-means (k = 3) on population-standardised site rates; all starts run side by side in
  one table, the lowest within-cluster cost is kept; clusters are named by ascending mean
  operating margin.
* D03: both series are residualised on site, weekday and month indicators plus
  log1p(orders) with an unstandardised ridge (alpha = 1), solved in
  closed form with site coefficients eliminated (grouped_ridge).
* D04: whole sites are resampled.  Each site is reduced once to six sums
  (n, sx, sy, sxx, syy, sxy); a resample is a multiset of sites, so its
  correlation follows in closed form from weighted sums.  Draws are stateless
  hashes of (replicate, position, seed): identical under retries and any
  partitioning.  No residual row is ever replicated.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.indexing import dense_index
from ..functions.semantics import broadcast_if_small, ratio
from ..session import stored
from .grouped_ridge import fit_grouped

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEGMENT_FEATURES = [
    "operating_margin_pct",
    "labour_cost_pct",
    "waste_pct",
    "satisfaction_score",
    "sales_per_labour_hour",
]
# Segment names, from lowest to highest mean operating margin.
SEGMENT_NAMES = ["Needs support", "Stable", "Efficient"]


#: Whole units per unit of a standardised rate: their sums don't depend on the order of addition.
UNITS = 10**9


def _lloyd_sums(centroids: np.ndarray):
    """Per task: (start, cluster, n, sums, cost) of the sites nearest to each centroid of every start."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        starts, k, d = centroids.shape
        n, sums, cost = np.zeros((starts, k), np.int64), np.zeros((starts, k, d), np.int64), np.zeros((starts, k))
        for batch in batches:
            z = np.stack(batch["z"].to_numpy()).astype(np.int64)
            gap = ((z[:, None, None, :] / UNITS - centroids[None]) ** 2).sum(3)
            near = gap.argmin(2)
            for s in range(starts):
                np.add.at(n[s], near[:, s], 1)
                np.add.at(sums[s], near[:, s], z)
                np.add.at(cost[s], near[:, s], gap[np.arange(len(z)), s, near[:, s]])
        used = np.argwhere(n)
        yield pd.DataFrame({"start": used[:, 0], "cluster": used[:, 1], "n": [n[s, c] for s, c in used], "sums": [sums[s, c].tolist() for s, c in used], "cost": [cost[s, c] for s, c in used]})

    return add


def best_centroids(z: DataFrame, key: str, k: int, n_init: int, seed: int, max_iter: int = 300) -> np.ndarray:
    """k centroids of the start with the lowest cost, from rows (key, z array of whole units).

    All starts are one table: a step is one job that sums every (start, cluster), and only
    ``n_init`` x ``k`` centroids come to the driver. A start begins at the k rows whose hash is
    smallest, so it depends neither on partitions nor on other starts; a cluster without rows
    keeps its centroid. Equal costs: the first start."""
    first = z.select("z", key, F.explode(F.sequence(F.lit(0), F.lit(n_init - 1))).alias("start"))
    by_hash = F.md5(F.concat_ws("|", F.col("start").cast("string"), F.col(key).cast("string"), F.lit(str(seed))))
    rank = F.row_number().over(Window.partitionBy("start").orderBy(by_hash, key))  # limited to k per task before the shuffle
    picked = first.withColumn("nth", rank).filter(F.col("nth") <= k).select("start", "nth", "z").orderBy("start", "nth").collect()
    if not picked:
        raise ValueError("no site has all segment rates")
    k = max(r["nth"] for r in picked)
    centroids = np.array([r["z"] for r in picked], np.float64).reshape(n_init, k, -1) / UNITS
    for _ in range(max_iter):
        found = z.mapInPandas(_lloyd_sums(centroids), "start int, cluster int, n long, sums array<long>, cost double")
        wide = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(centroids.shape[2])]
        found = found.groupBy("start", "cluster").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), F.array(*wide).alias("sums")).collect()
        moved, cost = centroids.copy(), np.zeros(n_init)
        for r in found:
            moved[r["start"], r["cluster"]] = np.array(r["sums"], np.float64) / r["n"] / UNITS
            cost[r["start"]] += r["cost"]
        if (moved == centroids).all():
            break
        centroids = moved
    return centroids[int(np.argmin(np.round(cost, 9)))]


def site_segments(
    totals: DataFrame, k: int = 3, n_init: int = 20, seed: int = 42, features: list[str] = SEGMENT_FEATURES
) -> DataFrame:
    """Cluster sites on population-standardised rates; cluster_id and name follow the rank of the
    cluster's mean margin (D01, K04). Sites without all rates are left out."""
    complete = totals.dropna(subset=features)
    stats = complete.agg(
        *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(features)],
        *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(features)],
    ).first()
    z = [(F.col(c) - F.lit(stats[f"m_{i}"])) / F.lit(stats[f"s_{i}"] or 1.0) for i, c in enumerate(features)]
    rows = stored(complete.withColumn("z", F.array(*(F.round(c * UNITS).cast("long") for c in z))), "segments")
    centroids = best_centroids(rows.select("restaurant_id", "z"), "restaurant_id", k, n_init, seed)

    def gap(centre) -> Column:
        parts = [F.pow(F.col("z")[i] / F.lit(float(UNITS)) - F.lit(float(v)), F.lit(2)) for i, v in enumerate(centre)]
        return sum(parts[1:], parts[0])

    near = F.array_min(F.array(*(F.struct(gap(c).alias("d"), F.lit(j).alias("cluster")) for j, c in enumerate(centroids))))
    labelled = rows.withColumn("_c", near["cluster"])
    rank = labelled.groupBy("_c").agg(F.avg("operating_margin_pct").alias("_m"))
    rank = rank.select("_c", (F.row_number().over(Window.orderBy("_m", "_c")) - 1).alias("cluster_id"))  # k rows
    name = F.element_at(F.array(*[F.lit(n) for n in SEGMENT_NAMES]), F.col("cluster_id") + 1)
    return labelled.join(F.broadcast(rank), "_c").withColumn("store_segment", name).drop("_c", "z")  # k rows


def association_sample(daily: DataFrame, min_surveys: int = 3, orders_per_service_hour: float = 6.0) -> DataFrame:
    """Site-days with at least ``min_surveys`` answers and a defined service pressure."""
    s = daily.filter(F.col("survey_responses") >= min_surveys).select(
        "restaurant_id", "business_date", "weekday", "month", "transactions",
        ratio("transactions", F.col("service_hours") * F.lit(orders_per_service_hour)).alias("service_pressure"),
        F.col("satisfaction_score").cast("double").alias("satisfaction_score"),
    )
    return s.dropna(subset=["service_pressure", "satisfaction_score"])


def residualised(sample: DataFrame, alpha: float = 1.0) -> DataFrame:
    """x = service pressure, y = satisfaction, both minus their ridge fit on the controls."""
    few = sample.agg(F.array_sort(F.collect_set("month")).alias("m")).first()  # twelve months of the year at most per year
    months = few["m"]
    site = {"site": F.lit(1.0)}
    cols = {f"weekday_{v}": (F.col("weekday") == v).cast("double") for v in range(7)}
    cols |= {f"month_{v}": (F.col("month") == v).cast("double") for v in months}
    cols["log_orders"] = F.log1p(F.col("transactions").cast("double"))
    labels = {c: F.col(c) for c in ("service_pressure", "satisfaction_score")}
    fits = fit_grouped(sample, "restaurant_id", site, cols, labels, alpha, scaled=False)
    if not fits:  # nothing to fit: no residuals (the correlation stays null)
        return sample.select(
            "restaurant_id", "business_date",
            F.lit(None).cast("double").alias("x_res"), F.lit(None).cast("double").alias("y_res"),
        ).filter(F.lit(False))
    d = sample
    for label, fit in fits.items():
        d = fit.predict(d, site, cols, f"_pred_{label}")
    return d.select(
        "restaurant_id", "business_date",
        (F.col("service_pressure") - F.col("_pred_service_pressure")).alias("x_res"),
        (F.col("satisfaction_score") - F.col("_pred_satisfaction_score")).alias("y_res"),
    )


def _corr(n: Column, sx: Column, sy: Column, sxx: Column, syy: Column, sxy: Column) -> Column:
    num = n * sxy - sx * sy
    den = F.sqrt((n * sxx - sx * sx) * (n * syy - sy * sy))
    return ratio(num, den)


def site_bootstrap(res: DataFrame, reps: int = 400, seed: int = 42) -> DataFrame:
    """(rep, correlation) for ``reps`` resamples of whole sites."""
    sums = res.groupBy("restaurant_id").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum("x_res").alias("sx"), F.sum("y_res").alias("sy"),
        F.sum(F.col("x_res") * F.col("x_res")).alias("sxx"), F.sum(F.col("y_res") * F.col("y_res")).alias("syy"),
        F.sum(F.col("x_res") * F.col("y_res")).alias("sxy"),
    )
    idx, n_sites = dense_index(sums, "restaurant_id", "site_index")
    if not n_sites:
        return idx.select(F.lit(0).cast("long").alias("rep"), F.lit(None).cast("double").alias("correlation"))
    # the draw table is a range cut over tasks: row i is draw i mod n of replicate i div n
    at = F.col("id")
    draws = res.sparkSession.range(reps * n_sites).select(F.floor(at / n_sites).alias("rep"), (at % n_sites).alias("pos"))
    h = F.md5(F.concat_ws("|", F.col("rep").cast("string"), F.col("pos").cast("string"), F.lit(str(seed))))
    draws = draws.select("rep", F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("long"), F.lit(n_sites).cast("long")).alias("site_index"))
    weights = draws.groupBy("rep", "site_index").agg(F.count(F.lit(1)).cast("double").alias("w"))
    j = weights.join(broadcast_if_small(idx), "site_index")
    agg = j.groupBy("rep").agg(*[F.sum(F.col("w") * F.col(c)).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    return agg.select("rep", _corr(*[F.col(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")]).alias("correlation"))


def staffing_association(daily: DataFrame, reps: int = 400, seed: int = 42, alpha: float = 1.0) -> DataFrame:
    """Controlled correlation of service pressure and satisfaction with a 95 %
    site-cluster bootstrap range (D03, D04).  One row."""
    res = residualised(association_sample(daily), alpha)
    point = res.agg(
        F.corr("x_res", "y_res").alias("controlled_correlation"), F.count(F.lit(1)).alias("store_days")
    )
    boot = site_bootstrap(res, reps, seed).agg(
        F.percentile("correlation", F.array(F.lit(0.025), F.lit(0.975))).alias("_q")
    )
    return point.crossJoin(boot).select(
        "controlled_correlation",
        F.col("_q")[0].alias("ci_low"),
        F.col("_q")[1].alias("ci_high"),
        "store_days",
        F.lit("Correlation of ridge residuals; sites resampled with their residuals kept").alias("method"),
        F.lit("An association only: who answers a survey is not random").alias("interpretation"),
    )
