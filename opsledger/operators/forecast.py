"""Rolling-origin seasonal-naive forecasts, error metrics and empirical bands.

The recursive lag-7 forecast has a closed form: day h after origin o repeats
the value observed on ``o - 6 + ((h - 1) mod 7)``.  Every fold, site and
horizon day is therefore one row produced by ``explode`` and two equi-joins
(forecast source day, actual day) -- no driver loop and no recursion.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import clip_lower, money_sum, ratio

MODEL = "Seasonal naive"


def folds(last_date: str, horizon: int = 28, validation: int = 3) -> list[tuple[str, int, int]]:
    """(period, fold, days before the last date) for validation folds and the holdout.

    Origins count back from the end: fold k of ``validation`` sits
    (validation + 2 - k) horizons before the last date; the holdout origin one
    horizon before it."""
    out = [("Validation", k, horizon * (validation + 2 - k)) for k in range(1, validation + 1)]
    out.append(("Holdout", 0, horizon))
    return out


def naive_forecasts(
    history: DataFrame, sites: DataFrame, origins: list[tuple[str, int, str]], horizon: int = 28
) -> DataFrame:
    """Seasonal-naive forecasts for every (origin, site, horizon day).

    ``origins`` holds (period, fold, origin_date).  Only history on or before
    each origin feeds its forecasts (the source day is always <= origin).
    """
    arr = F.array(
        *[F.struct(F.lit(p).alias("evaluation_period"), F.lit(k).alias("fold"), F.lit(o).cast("date").alias("origin_date"))
          for p, k, o in origins]
    )
    base = sites.select("restaurant_id", F.explode(arr).alias("o")).select("restaurant_id", "o.*")
    base = base.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("horizon_day"))
    base = base.withColumns(
        {
            "business_date": F.date_add("origin_date", F.col("horizon_day")),
            "_src": F.date_add("origin_date", F.lit(-6) + F.pmod(F.col("horizon_day") - 1, F.lit(7))),
        }
    )
    src = history.select("restaurant_id", F.col("business_date").alias("_src"), F.col("revenue").alias("_v"))
    f = base.join(src, ["restaurant_id", "_src"], "left")
    return f.select(
        "restaurant_id", "business_date", "horizon_day",
        clip_lower(F.col("_v"), 0.0).alias("forecast_revenue"),
        F.lit(MODEL).alias("model"), "origin_date", "evaluation_period", "fold",
    )


def backtest(history: DataFrame, sites: DataFrame, last_date: str, horizon: int = 28) -> DataFrame:
    """Validation folds and holdout traces joined to actuals."""
    last = date.fromisoformat(last_date)
    trips = [(p, k, str(last - timedelta(days=back))) for p, k, back in folds(last_date, horizon)]
    f = naive_forecasts(history, sites, trips, horizon)
    actual = history.select("restaurant_id", "business_date", F.col("revenue").alias("actual_revenue"))
    return f.join(actual, ["restaurant_id", "business_date"])


def metrics(traces: DataFrame, keys: list[str]) -> DataFrame:
    """MAE, RMSE, MAPE (positive actuals), WAPE in percent."""
    e = F.col("actual_revenue") - F.col("forecast_revenue")
    return traces.groupBy(*keys).agg(
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.avg(F.when(F.col("actual_revenue") > 0, F.abs(e) / F.col("actual_revenue"))) * 100).alias("mape"),
        (ratio(F.sum(F.abs(e)), F.sum("actual_revenue")) * 100).alias("wape"),
        F.count(F.lit(1)).alias("observations"),
    )


def select_winner(fold_metrics: DataFrame) -> DataFrame:
    """Model with the lowest mean validation MAE; the holdout never selects."""
    v = fold_metrics.filter(F.col("evaluation_period") == "Validation")
    m = v.groupBy("model").agg(F.avg("mae").alias("mean_validation_mae"))
    return m.agg(F.min_by("model", F.struct("mean_validation_mae", "model")).alias("winner"))


def chosen(rows: DataFrame, winner: DataFrame) -> DataFrame:
    """Rows (traces or forecasts) of the model that the selection names: a semi join on its one row."""
    return rows.join(F.broadcast(winner.select(F.col("winner").alias("model"))), "model", "left_semi")


def error_bands(traces: DataFrame, quantile: float = 0.8) -> DataFrame:
    """Per-site quantile of absolute validation error."""
    v = traces.filter(F.col("evaluation_period") == "Validation")
    e = F.abs(F.col("actual_revenue") - F.col("forecast_revenue"))
    return v.groupBy("restaurant_id").agg(F.percentile(e, quantile).alias("band"))


def with_bands(forecasts: DataFrame, bands: DataFrame) -> DataFrame:
    f = forecasts.join(bands, "restaurant_id", "left")
    return f.withColumns(
        {
            "lower_80": clip_lower(F.col("forecast_revenue") - F.col("band"), 0.0),
            "upper_80": F.col("forecast_revenue") + F.col("band"),
        }
    ).drop("band")
