"""Diagnostics over the marts: robust sales anomalies, KPI correlations,
opportunities, staffing patterns and chain trends."""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.semantics import broadcast_if_small, clip_lower, exact_avg, ratio
from .kpi import calculate, sum_additive

CORR_FIELDS = [
    "operating_margin_pct",
    "labour_cost_pct",
    "waste_pct",
    "satisfaction_score",
    "sales_per_labour_hour",
    "average_transaction_value",
    "late_delivery_pct",
]
PEAK_HOURS = [12, 13, 18, 19]
OFF_PEAK_HOURS = [14, 15, 16, 17]


def _array_median(arr):
    """Median of a sorted numeric array (average of the two middle values)."""
    n = F.size(arr)
    lo = F.try_element_at(arr, F.floor((n + 1) / 2).cast("int"))
    hi = F.try_element_at(arr, F.floor(n / 2).cast("int") + 1)
    return (lo + hi) / 2.0


def sales_anomalies(
    daily: DataFrame,
    value: str = "revenue",
    window: int = 12,
    min_periods: int = 8,
    threshold: float = 3.5,
) -> DataFrame:
    """Robust z against the prior same-weekday rows.

    * prior median: rows -window..-1, needs ``min_periods`` values;
    * prior MAD: median absolute deviation of the same rows, needs a full
      window (the leading gap counts as missing);
    * z = 0.6745 (x - median) / MAD, MAD = 0 gives null; flag |z| > threshold.

    Windows are partitioned by (site, weekday); each holds one site-weekday
    series of the small daily mart.
    """
    w = Window.partitionBy("restaurant_id", "weekday").orderBy("business_date").rowsBetween(-window, -1)
    prior = F.array_sort(F.collect_list(value).over(w))
    d = daily.withColumn("_prior", prior).withColumn("_n", F.size("_prior"))
    med = F.when(F.col("_n") >= min_periods, _array_median(F.col("_prior")))
    d = d.withColumn("prior_median", med)
    full_med = _array_median(F.col("_prior"))
    dev = F.array_sort(F.transform("_prior", lambda x: F.abs(x - full_med)))
    d = d.withColumn("prior_mad", F.when(F.col("_n") == window, _array_median(dev)))
    z = F.lit(0.6745) * (F.col(value) - F.col("prior_median")) / F.when(F.col("prior_mad") != 0, F.col("prior_mad"))
    d = d.withColumn("robust_z", z)
    return d.withColumn("is_anomaly", F.coalesce(F.abs("robust_z") > threshold, F.lit(False))).drop("_prior", "_n")


def kpi_correlations(monthly: DataFrame, fields: list[str] = CORR_FIELDS) -> DataFrame:
    """Pairwise-complete Pearson matrix in long form, from one aggregate."""
    pairs = list(product(fields, fields))
    agg = monthly.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    arr = F.array(
        *[
            F.struct(F.lit(a).alias("metric"), F.lit(b).alias("other"), F.col(f"{a}__{b}").alias("correlation"))
            for a, b in pairs
        ]
    )
    return agg.select(F.explode(arr).alias("x")).select("x.*")


def driver_ranking(corr: DataFrame, target: str = "operating_margin_pct") -> DataFrame:
    """Correlations with the target ordered by absolute size."""
    c = corr.filter((F.col("metric") == target) & (F.col("other") != target))
    w = Window.partitionBy("metric").orderBy(F.abs("correlation").desc_nulls_last(), "other")
    return c.withColumn("rank", F.row_number().over(w))


def latest_opportunities(monthly: DataFrame, restaurants: DataFrame, since: str) -> DataFrame:
    """Latest-period rates, mean monthly index, peer-median waste gap."""
    latest = monthly.filter(F.col("month") >= since)
    perf = calculate(sum_additive(latest, ["restaurant_id"]))
    idx = latest.groupBy("restaurant_id").agg(F.avg("performance_index").alias("performance_index"))
    perf = perf.join(broadcast_if_small(restaurants), "restaurant_id").join(idx, "restaurant_id")
    peer = perf.groupBy("location_type").agg(F.median("waste_pct").alias("waste_peer_median"))
    perf = perf.join(broadcast_if_small(peer), "location_type")
    return perf.withColumn(
        "estimated_waste_opportunity",
        clip_lower(F.col("waste_pct") - F.col("waste_peer_median"), 0.0) * (F.col("ingredient_cost") + F.col("waste_cost")),
    )


def staffing_patterns(hourly: DataFrame) -> DataFrame:
    """Mean demand and capacity, pressure / spare counts by site, weekday, hour."""
    g = hourly.groupBy("restaurant_id", "weekday", "hour").agg(
        F.avg("transactions").alias("transactions"),
        exact_avg("service_capacity_orders").alias("capacity"),
        F.count_if(F.col("staffing_status") == "Pressure").alias("pressure_hours"),
        F.count(F.lit(1)).alias("observations"),
        F.count_if(F.col("staffing_status") == "Spare capacity").alias("spare_hours"),
    )
    return g.withColumn("pressure_share", ratio("pressure_hours", "observations"))


def pressure_heatmap(hourly: DataFrame, hours: range = range(11, 22)) -> DataFrame:
    """Weekday x hour share of Pressure hours as a pivot."""
    flag = (F.col("staffing_status") == "Pressure").cast("double")
    p = hourly.withColumn("_p", flag).groupBy("weekday").pivot("hour", list(hours)).agg(F.avg("_p"))
    return p.select("weekday", *[F.col(str(h)).alias(f"h{h}") for h in hours])


def peak_shares(hourly: DataFrame) -> DataFrame:
    """Pressure and spare shares in peak vs off-peak hours."""
    pressure = (F.col("staffing_status") == "Pressure").cast("double")
    spare = (F.col("staffing_status") == "Spare capacity").cast("double")
    peak = F.col("hour").isin(PEAK_HOURS)
    off = F.col("hour").isin(OFF_PEAK_HOURS)
    return hourly.agg(
        F.avg(F.when(peak, pressure)).alias("peak_pressure_share"),
        F.avg(F.when(off, pressure)).alias("off_peak_pressure_share"),
        F.avg(F.when(peak, spare)).alias("peak_spare_share"),
        F.avg(F.when(off, spare)).alias("off_peak_spare_share"),
        F.avg(pressure).alias("pressure_hour_share"),
    )


def chain_trend(daily: DataFrame, grain: str = "month") -> DataFrame:
    """Chain totals and rates per month (or day)."""
    return calculate(sum_additive(daily, [grain]))


def category_contribution(product_month: DataFrame) -> DataFrame:
    """Revenue, contribution and margin per category."""
    from ..functions.semantics import money_sum

    g = product_month.groupBy("category").agg(
        money_sum("revenue").alias("revenue"),
        money_sum("ingredient_cost").alias("ingredient_cost"),
        F.sum("units").alias("units"),
    )
    g = g.withColumn("gross_contribution", F.col("revenue") - F.col("ingredient_cost"))
    return g.withColumn("gross_margin_pct", ratio("gross_contribution", "revenue"))


def category_leaders(categories: DataFrame) -> DataFrame:
    """Top category by revenue and by margin (arg-max, K03)."""
    return categories.agg(
        F.max_by("category", F.struct("revenue", "category")).alias("top_category"),
        F.max_by("category", F.struct("gross_margin_pct", "category")).alias("highest_margin_category"),
    )
