"""Customer recency/frequency segments, 90-day repeat cohorts, early behaviour.

Plan: first visit per customer (partial aggregation), joined back to the
customer's orders, then one grouped pass computes every per-customer measure.
Both shuffles are keyed by customer_id with map-side combine; a customer with
a huge number of orders is split by AQE's skew-join handling, never gathered
into a single window partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import first_match, money_sum, ratio

# Segment rules in priority order (fixed values)
SEGMENTS = [
    ("Champions", "recency_days <= 30 AND visits >= 12"),
    ("Lapsed", "recency_days > 90"),
    ("New / occasional", "visits <= 2 AND recency_days <= 30"),
    ("Regulars", "visits >= 6"),
]
DEFAULT_SEGMENT = "Developing"
EARLY_BANDS = ["1 visit", "2–3 visits", "4+ visits"]


def customer_profiles(orders: DataFrame, loyalty: DataFrame, repeat_days: int = 90) -> DataFrame:
    """One row per identified customer."""
    ident = orders.filter(F.col("customer_id").isNotNull())
    asof = ident.select(F.max("business_date")).scalar()
    first = ident.groupBy("customer_id").agg(F.min("business_date").alias("first_visit"))
    e = ident.join(first, "customer_id").withColumn(
        "days", F.datediff("business_date", "first_visit")
    )
    c = e.groupBy("customer_id").agg(
        F.min("first_visit").alias("first_visit"),
        F.max("business_date").alias("last_visit"),
        F.countDistinct("business_date").alias("visits"),
        F.count(F.lit(1)).alias("orders"),
        money_sum("revenue").alias("spend"),
        F.min_by("restaurant_id", F.struct("business_date", "order_id")).alias("restaurant_id"),
        F.max(F.col("days").between(1, repeat_days)).alias("_rep"),
        F.max(F.col("days").between(31, repeat_days)).alias("_later"),
        F.countDistinct(F.when(F.col("days").between(0, 30), F.col("business_date"))).alias("early_visits"),
    )
    redeem = (
        loyalty.filter(F.col("event_type") == "Redeem")
        .join(first, "customer_id")
        .filter(F.datediff("event_date", "first_visit").between(0, 30))
        .select("customer_id")
        .distinct()
        .withColumn("early_redemption", F.lit(True))
    )
    c = c.join(redeem, "customer_id", "left").fillna(False, subset=["early_redemption"])
    c = c.withColumn("recency_days", F.datediff(asof, F.col("last_visit")))
    seg = first_match([(F.expr(cond), name) for name, cond in SEGMENTS], DEFAULT_SEGMENT)
    eligible = F.col("first_visit") <= F.date_sub(asof, repeat_days)
    v = F.col("early_visits")
    band = first_match(
        [(v <= 0, "nan"), (v <= 1, EARLY_BANDS[0]), (v <= 3, EARLY_BANDS[1])], EARLY_BANDS[2]
    )
    return c.select(
        "customer_id",
        "first_visit",
        "last_visit",
        "visits",
        "orders",
        "spend",
        "restaurant_id",
        "recency_days",
        seg.alias("segment"),
        eligible.alias("eligible_90d"),
        F.when(eligible, F.col("_rep").cast("int")).alias("repeat_within_90d"),
        F.when(eligible, F.col("_later").cast("int")).alias("return_days31_90"),
        "early_redemption",
        "early_visits",
        band.alias("early_activity_band"),
        F.date_format("first_visit", "yyyy-MM").alias("cohort_month"),
    )


def cohorts(profiles: DataFrame) -> DataFrame:
    """Site x first-visit month: customers, eligible, repeaters, rate."""
    g = profiles.groupBy("restaurant_id", "cohort_month").agg(
        F.count(F.lit(1)).alias("identified_customers"),
        F.count_if("eligible_90d").alias("eligible_customers"),
        F.sum("repeat_within_90d").alias("repeat_customers"),
    )
    return g.withColumn("repeat_customer_rate", ratio("repeat_customers", "eligible_customers"))


def behaviours(profiles: DataFrame) -> DataFrame:
    """Early activity band x early redemption among eligible customers."""
    g = (
        profiles.filter("eligible_90d")
        .groupBy("early_activity_band", "early_redemption")
        .agg(F.count(F.lit(1)).alias("customers"), F.sum("return_days31_90").alias("later_returners"))
    )
    return g.withColumn("later_return_rate", ratio("later_returners", "customers"))


def segment_summary(profiles: DataFrame) -> DataFrame:
    """Customers, spend, visits, eligible and repeaters per site and segment."""
    return profiles.groupBy("restaurant_id", "segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("spend").alias("spend"),
        F.sum("visits").alias("visits"),
        F.count_if("eligible_90d").alias("eligible_customers"),
        F.sum("repeat_within_90d").alias("repeat_customers"),
    )


def first_events(events: DataFrame, entity: str, order_cols: list[str]) -> DataFrame:
    """First event per entity by an ordering (W09), as a min-by aggregate."""
    payload = [c for c in events.columns if c != entity]
    g = events.groupBy(entity).agg(
        F.min_by(F.struct(*payload), F.struct(*order_cols)).alias("_first")
    )
    return g.select(entity, *[F.col(f"_first.{c}").alias(c) for c in payload])
