"""Feature matrix, the calendar-ridge and the boosted challenger.

Features per (site, day): site and weekday indicators, site x weekend,
annual sine / cosine, trend in years, public holiday, and the lagged values
lag7, lag28, mean28 (mean of the 28 previous days).  Lags are row offsets on
the gap-free daily spine, taken only from days before the target day.

The ridge (alpha on population-standardised features, unpenalised intercept)
is solved in closed form by eliminating each site's own coefficients
(:mod:`grouped_ridge`): one path for any number of sites, no column per site.

Forecasts are recursive (each day's prediction feeds the next day's lags).
Because the model is linear, the calendar part of every future row is an
ordinary column expression and only the lag part recurses: per site one SQL
``aggregate`` folds the 28 horizon days over an array state holding the last
28 values.  No driver loop over days or sites; one fit per origin.
"""

from __future__ import annotations

import math
import sys
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.semantics import broadcast_if_small, clip_lower, money_sum, snap, unique_on, weekday
from . import histogram_boosting as boosting
from .grouped_ridge import GroupedFit, fit_grouped

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MODEL = "Calendar ridge"
LAGS = ("lag7", "lag28", "mean28")


def calendar_columns(start_date: str) -> dict[str, Column]:
    """Origin-known calendar features of ``business_date``."""
    doy = F.dayofyear("business_date").cast("double")
    return {
        "weekday": weekday("business_date"),
        "is_weekend": (weekday("business_date") >= 5).cast("int"),
        "annual_sin": F.sin(F.lit(2 * math.pi) * doy / F.lit(365.25)),
        "annual_cos": F.cos(F.lit(2 * math.pi) * doy / F.lit(365.25)),
        "trend_years": F.datediff("business_date", F.lit(start_date).cast("date")) / F.lit(365.25),
    }


def feature_rows(history: DataFrame, restaurants: DataFrame, calendar: DataFrame, start_date: str) -> DataFrame:
    """Training rows with calendar features and lags; rows missing a lag dropped."""
    w = Window.partitionBy("restaurant_id").orderBy("business_date")  # one site's days: bounded by history length
    prior = w.rowsBetween(-28, -1)
    h = history.select("restaurant_id", "business_date", "revenue").withColumns(
        {
            "lag7": F.lag("revenue", 7).over(w),
            "lag28": F.lag("revenue", 28).over(w),
            "mean28": F.when(F.count("revenue").over(prior) == 28, F.avg("revenue").over(prior)),
        }
    )
    h = h.dropna(subset=list(LAGS))
    hol = calendar.select("business_date", "state", F.col("is_public_holiday").alias("holiday"))
    sites = restaurants.select("restaurant_id", "state")
    return (
        h.join(broadcast_if_small(unique_on(sites, "restaurant_id")), "restaurant_id")
        .join(unique_on(hol, ["business_date", "state"]), ["business_date", "state"])
        .drop("state")
        .withColumns(calendar_columns(start_date))
    )


def site_features() -> dict[str, Column]:
    """What every site has a coefficient of its own for."""
    return {"store": F.lit(1.0), "weekend_store": (F.col("weekday") >= 5).cast("double")}


def common_features(lags: bool = True) -> dict[str, Column]:
    cols = {f"weekday_{d}": (F.col("weekday") == d).cast("double") for d in range(7)}
    for c in ("annual_sin", "annual_cos", "trend_years", "holiday", *(LAGS if lags else ())):
        cols[c] = F.col(c).cast("double")
    return cols


def fit_ridge(train: DataFrame, alpha: float = 60.0) -> GroupedFit:
    """Ridge on population-standardised features (zero variance -> scale 1)."""
    fits = fit_grouped(train, "restaurant_id", site_features(), common_features(), {"revenue": F.col("revenue")}, alpha)
    if not fits:
        raise ValueError("no training rows for the ridge")
    return fits["revenue"]


def recursive_forecast(
    fit: GroupedFit,
    history: DataFrame,
    restaurants: DataFrame,
    calendar: DataFrame,
    origin: str,
    start_date: str,
    horizon: int = 28,
) -> DataFrame:
    """28-day recursive ridge forecast from ``origin`` for every site.

    Only history on or before the origin is read (F05).  Predictions are
    clipped at 0 before they feed later lags.
    """
    o = F.lit(origin).cast("date")
    sites = restaurants.select("restaurant_id", "state")
    fut = sites.select(
        "restaurant_id", "state", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("horizon_day")
    ).withColumn("business_date", F.date_add(o, F.col("horizon_day")))
    hol = calendar.select("business_date", "state", F.col("is_public_holiday").alias("holiday"))
    fut = fut.join(hol, ["business_date", "state"], "left").fillna(0, subset=["holiday"]).withColumns(
        calendar_columns(start_date)
    )
    fut = fit.predict(fut, site_features(), common_features(lags=False), "base")
    fut = fut.select("restaurant_id", "horizon_day", "business_date", "base")
    per_site = fut.groupBy("restaurant_id").agg(
        F.array_sort(F.collect_list(F.struct("horizon_day", "base"))).alias("days")  # horizon-bounded
    )
    # last 28 actual values up to the origin (gap-free spine)
    last = (
        history.filter((F.col("business_date") <= o) & (F.col("business_date") > F.date_sub(o, 28)))
        .groupBy("restaurant_id")
        .agg(F.array_sort(F.collect_list(F.struct("business_date", "revenue"))).alias("tail"))
        .select("restaurant_id", F.transform("tail", lambda s: s["revenue"].cast("double")).alias("state"))
    )
    w7, w28, wm = (F.lit(fit.common[c]) for c in LAGS)

    def step(state, d):
        n = F.size(state)
        last28 = F.slice(state, n - 27, 28)
        mean28 = F.aggregate(last28, F.lit(0.0), lambda a, v: a + v) / F.lit(28.0)
        pred = d["base"] + w7 * F.element_at(state, n - 6) + w28 * F.element_at(state, n - 27) + wm * mean28
        return F.concat(state, F.array(F.greatest(pred, F.lit(0.0))))

    rec = per_site.join(last, "restaurant_id").select(
        "restaurant_id", F.slice(F.aggregate("days", F.col("state"), step), 29, horizon).alias("pred")
    )
    out = rec.select("restaurant_id", F.posexplode("pred").alias("i", "forecast_revenue"))
    return out.select(
        "restaurant_id",
        F.date_add(o, F.col("i") + 1).alias("business_date"),
        (F.col("i") + 1).alias("horizon_day"),
        snap(clip_lower(F.col("forecast_revenue"), 0.0), 2).alias("forecast_revenue"),  # whole cents
        F.lit(MODEL).alias("model"),
        o.alias("origin_date"),
    )


def ridge_backtest(
    history: DataFrame,
    restaurants: DataFrame,
    calendar: DataFrame,
    origins: list[tuple[str, int, str]],
    start_date: str,
    alpha: float = 60.0,
    horizon: int = 28,
    rows: DataFrame | None = None,
) -> DataFrame:
    """Ridge traces for (period, fold, origin) triples joined to actuals; one fit
    per origin on rows up to that origin only.  ``rows`` are precomputed
    :func:`feature_rows` (e.g. a stored table reused by every fit)."""
    if rows is None:
        rows = feature_rows(history, restaurants, calendar, start_date)
    actual = history.select("restaurant_id", "business_date", F.col("revenue").alias("actual_revenue"))
    # a fit is a chain of short jobs: those of different origins run side by side
    with ThreadPoolExecutor(len(origins)) as pool:
        fits = list(pool.map(lambda o: fit_ridge(rows.filter(F.col("business_date") <= F.lit(o[2]).cast("date")), alpha), origins))
    parts = []
    for (period, fold, origin), fit in zip(origins, fits, strict=True):
        f = recursive_forecast(fit, history, restaurants, calendar, origin, start_date, horizon)
        parts.append(
            f.withColumns({"evaluation_period": F.lit(period), "fold": F.lit(fold)}).join(
                actual, ["restaurant_id", "business_date"]
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- F04
GBT_MODEL = "Gradient boosting"
CALENDAR = ("weekday", "annual_sin", "annual_cos", "trend_years", "holiday")
BOOST_FEATURES = ["site_level", *CALENDAR, *LAGS]


def boosted_rows(rows: DataFrame, origins: list[str]) -> tuple[DataFrame, DataFrame]:
    """Training rows of every origin (fold = its place in the list), and each site's level per fold.

    The site enters as one number, its mean revenue up to the origin, which the model bins like any
    other feature: no column and no list per site."""
    o = F.array(*(F.struct(F.lit(k).alias("fold"), F.lit(d).cast("date").alias("origin_date")) for k, d in enumerate(origins)))
    train = rows.select("*", F.explode(o).alias("_o")).select(*rows.columns, "_o.*")
    train = train.filter(F.col("business_date") <= F.col("origin_date"))
    level = train.groupBy("fold", "restaurant_id").agg((money_sum("revenue") / F.count("revenue")).alias("site_level"))
    return train.join(level, ["fold", "restaurant_id"]).withColumn("target", F.col("revenue").cast("double")), level


def _boosted_days(models: dict, horizon: int):
    """Sites' horizons, one day after the other: each day's prediction feeds the lags of the next."""

    def predict(batches):
        for batch in batches:
            for fold, part in batch.groupby("fold"):
                model = models[fold]
                state = np.stack(part["state"].to_numpy()).astype(np.float64)
                days = np.array([[[d[c] for c in CALENDAR] for d in row] for row in part["days"]], np.float64)
                level = part["site_level"].fillna(model.mean).to_numpy(np.float64)
                for h in range(horizon):
                    lags = np.column_stack([state[:, -7], state[:, -28], state[:, -28:].mean(1)])
                    day = np.maximum(model.predict(np.column_stack([level, days[:, h], lags])), 0.0)
                    state = np.column_stack([state, day])
                n = len(part)
                yield pd.DataFrame(
                    {
                        "fold": fold, "restaurant_id": np.repeat(part["restaurant_id"].to_numpy(), horizon),
                        "horizon_day": np.tile(np.arange(1, horizon + 1), n), "forecast_revenue": state[:, 28:].ravel(),
                    }
                )

    return predict


def boosted_forecast(
    models: dict, level: DataFrame, history: DataFrame, restaurants: DataFrame, calendar: DataFrame, origins: list[str], start_date: str, horizon: int = 28
) -> DataFrame:
    """Recursive forecasts of every origin and site in one job; history after an origin is not read.

    A site needs 28 days up to the origin; one that no training row has gets the mean level."""
    o = F.array(*(F.struct(F.lit(k).alias("fold"), F.lit(d).cast("date").alias("origin_date")) for k, d in enumerate(origins)))
    hol = calendar.select("business_date", "state", F.col("is_public_holiday").alias("holiday"))
    fut = restaurants.select("restaurant_id", "state", F.explode(o).alias("_o")).select("restaurant_id", "state", "_o.*")
    fut = fut.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("horizon_day"))
    fut = fut.withColumn("business_date", F.date_add("origin_date", F.col("horizon_day"))).join(hol, ["business_date", "state"], "left")
    fut = fut.fillna(0, subset=["holiday"]).withColumns(calendar_columns(start_date))
    fut = fut.groupBy("fold", "restaurant_id").agg(F.array_sort(F.collect_list(F.struct("horizon_day", *(F.col(c).cast("double").alias(c) for c in CALENDAR)))).alias("days"))
    tail = history.select("restaurant_id", "business_date", F.col("revenue").cast("double").alias("revenue"), F.explode(o).alias("_o"))
    tail = tail.select("*", "_o.*").filter((F.col("business_date") <= F.col("origin_date")) & (F.col("business_date") > F.date_sub("origin_date", 28)))
    tail = tail.groupBy("fold", "restaurant_id").agg(F.array_sort(F.collect_list(F.struct("business_date", "revenue"))).alias("tail")).filter(F.size("tail") == 28)
    state = F.transform("tail", lambda x: x["revenue"]).alias("state")
    rows = fut.join(tail, ["fold", "restaurant_id"]).join(level, ["fold", "restaurant_id"], "left").select("fold", "restaurant_id", "days", state, "site_level")
    kind = dict(restaurants.dtypes)["restaurant_id"]
    out = rows.mapInPandas(_boosted_days(models, horizon), f"fold int, restaurant_id {kind}, horizon_day int, forecast_revenue double")
    at = F.element_at(F.array(*(F.lit(d).cast("date") for d in origins)), F.col("fold") + 1)
    return out.select(
        "fold", "restaurant_id", F.date_add(at, F.col("horizon_day")).alias("business_date"), "horizon_day", "forecast_revenue",
        F.lit(GBT_MODEL).alias("model"), at.alias("origin_date"),
    )


def gbt_backtest(
    history: DataFrame,
    restaurants: DataFrame,
    calendar: DataFrame,
    origins: list[tuple[str, int, str]],
    start_date: str,
    rows: DataFrame | None = None,
    horizon: int = 28,
    params: boosting.Params = boosting.Params(),
) -> DataFrame:
    """Boosted traces for each (period, fold, origin), joined to actuals.

    All origins are fitted side by side: one pass per tree level serves every fold."""
    if rows is None:
        rows = feature_rows(history, restaurants, calendar, start_date)
    dates = [d for _, _, d in origins]
    train, level = boosted_rows(rows, dates)
    models = boosting.fit(train, BOOST_FEATURES, params)
    f = boosted_forecast(models, level, history, restaurants, calendar, dates, start_date, horizon)
    named = {c: F.element_at(F.array(*(F.lit(o[k]) for o in origins)), F.col("_o") + 1) for k, c in enumerate(("evaluation_period", "fold"))}
    actual = history.select("restaurant_id", "business_date", F.col("revenue").alias("actual_revenue"))
    return f.withColumnRenamed("fold", "_o").withColumns(named).drop("_o").join(actual, ["restaurant_id", "business_date"])
