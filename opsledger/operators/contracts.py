"""Contracts of the action log: plans, proposals, outcomes, completion, reviews, register.

A contract is an ordered table of named rules; every rule is a column that is true when broken,
and an undecidable rule counts as broken. Checking a table adds the list of broken rules to
each row in one pass, so nothing is validated row by row outside Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import invalid_if_unknown, ratio
from .actions import TERMINAL
from .scenarios import LEVERS, Scenario, outcome

# The metrics a plan may pursue, whether more or less is better, and the range
# of their targets and of recorded values.
METRICS: dict[str, tuple[str, float, float]] = {
    "labour_cost_pct": ("lower", 0.0, 1.0),
    "waste_pct": ("lower", 0.0, 1.0),
    "operating_margin_pct": ("higher", -1.0, 1.0),
    "satisfaction_score": ("higher", 1.0, 5.0),
    "operating_profit": ("higher", float("-inf"), float("inf")),
    "revenue": ("higher", 0.0, float("inf")),
}
GUARDRAILS = {"satisfaction_score": (1.0, 5.0), "late_delivery_pct": (0.0, 1.0)}
OUTCOME_KINDS = {"simulated": "Simulated", "user_entered": "Entered by a user, not verified"}
PLAN_TEXTS = ("problem", "evidence", "intervention", "owner", "comparison_approach", "expected_impact_basis")
PLAN_DATES = ("start_date", "end_date", "measurement_start", "measurement_end")

Rules = dict[str, Column]


def broken(rules: Rules) -> Column:
    """Names of the broken rules of a row, in contract order."""
    return F.filter(F.array(*(F.when(invalid_if_unknown(bad), F.lit(name)) for name, bad in rules.items())), lambda x: x.isNotNull())


def check(df: DataFrame, rules: Rules) -> DataFrame:
    """Add ``broken_rules`` (text, joined by '; ') and ``valid``."""
    return df.withColumn("broken_rules", F.array_join(broken(rules), "; ")).withColumn("valid", F.col("broken_rules") == "")


def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))


def _outside(value: Column, low: float, high: float) -> Column:
    return ~(_finite(value) & (value >= low) & (value <= high))


def _blank(c: Column) -> Column:
    return F.coalesce(F.trim(c) == "", F.lit(True))


def _metric_outside(metric: Column, value: Column) -> Column:
    """Whether a value is out of its metric's range; unknown metrics are judged elsewhere."""
    out = ~_finite(value)
    for name, (_, low, high) in METRICS.items():
        out = out | ((metric == name) & ((value < low) | (value > high)))
    return out


# ---------------------------------------------------------------- E04
def plan_rules() -> Rules:
    c = F.col
    any_blank = F.lit(False)
    for t in PLAN_TEXTS:
        any_blank = any_blank | _blank(c(t))
    no_date = F.lit(False)
    for d in PLAN_DATES:
        no_date = no_date | c(d).isNull()
    return {
        "every text is filled in": any_blank,
        "all four dates are given": no_date,
        "pilot does not end before it starts": c("start_date") > c("end_date"),
        "measurement does not end before it starts": c("measurement_start") > c("measurement_end"),
        "measurement lies inside the pilot": (c("measurement_start") < c("start_date")) | (c("measurement_end") > c("end_date")),
        "pilot starts after the baseline month": F.date_format("start_date", "yyyy-MM") <= c("period"),
        "metric is known": ~c("primary_metric").isin(list(METRICS)),
        "target suits the metric": _metric_outside(c("primary_metric"), c("target")),
        "score guardrail is a score": _outside(c("satisfaction_min"), *GUARDRAILS["satisfaction_score"]),
        "late guardrail is a share": _outside(c("late_delivery_max"), *GUARDRAILS["late_delivery_pct"]),
    }


def plan_contract(revisions: DataFrame) -> DataFrame:
    """Every revision's plan against the measurement-plan contract."""
    return check(revisions, plan_rules())


# ---------------------------------------------------------------- E10
def proposal_contract(proposals: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Proposals with their frozen baseline ledger and source.

    The baseline must be a ledger whose profit the scenario arithmetic reproduces.
    """
    c = F.col
    rows = outcome(proposals, lambda k: F.lit(getattr(Scenario(), k)).cast("double"), "_base")
    rules = {
        "site id is positive": c("restaurant_id") <= 0,
        "period is a month": ~c("period").rlike("^[0-9]{4}-(0[1-9]|1[0-2])$"),
        "site name is filled in": _blank(c("restaurant_name")),
        "baseline reproduces its profit": F.abs(c("_base.operating_profit") - c("operating_profit")) > tolerance + 1e-9,
        "source has a fingerprint": ~c("source_fingerprint").rlike("^[0-9a-f]{64}$"),
        "source is of the same period": c("source_period") != c("period"),
        "source is synthetic history": c("data_kind") != "synthetic_history",
    }
    return check(rows, rules).drop("_base")


def draft_plans(proposals: DataFrame, scenario: Scenario) -> DataFrame:
    """Default plan of a proposal (E10): the whole next month, the scenario's labour share as target."""
    first = F.add_months(F.try_to_date(F.concat("period", F.lit("-01"))), 1)
    plan = outcome(proposals, lambda k: F.lit(getattr(scenario, k)).cast("double"), "_after")
    return plan.select(
        "action_id", "restaurant_id", "period", first.alias("start_date"), F.last_day(first).alias("end_date"),
        first.alias("measurement_start"), F.last_day(first).alias("measurement_end"),
        F.lit("labour_cost_pct").alias("primary_metric"), ratio("_after.labour_cost", "_after.revenue").alias("target"),
    )


# ---------------------------------------------------------------- E09
def _with_plan(outcomes: DataFrame, revisions: DataFrame) -> DataFrame:
    plan = revisions.select("action_id", "revision", "primary_metric", "target", "satisfaction_min", "late_delivery_max", "measurement_start", "measurement_end")
    return outcomes.join(plan, ["action_id", "revision"], "left")


def outcome_contract(outcomes: DataFrame, revisions: DataFrame) -> DataFrame:
    """Recorded outcomes against the plan of the revision they name.

    ``outcomes`` has action_id, revision, latest_revision and action_status as of recording, kind,
    window_start, window_end and metrics (map)."""
    c = F.col
    value = F.element_at("metrics", c("primary_metric"))
    asked = F.array_distinct(F.array(c("primary_metric"), *map(F.lit, GUARDRAILS)))
    off = F.lit(False)
    for name, (low, high) in GUARDRAILS.items():
        off = off | _outside(F.element_at("metrics", F.lit(name)), low, high)
    rules = {
        "action is in progress": c("action_status") != "in progress",
        "revision is the latest": c("revision") != c("latest_revision"),
        "kind is known": ~c("kind").isin(list(OUTCOME_KINDS)),
        "window lies inside the measurement": (c("window_start") > c("window_end")) | (c("window_start") < c("measurement_start")) | (c("window_end") > c("measurement_end")),
        "metrics are those of the plan": (F.size(F.array_except(asked, F.map_keys("metrics"))) > 0) | (F.size(F.array_except(F.map_keys("metrics"), asked)) > 0),
        "service metrics are in range": off,
        "primary value suits the metric": _metric_outside(c("primary_metric"), value),
    }
    return check(_with_plan(outcomes, revisions), rules)


# ---------------------------------------------------------------- E05
def completion_gate(events: DataFrame, outcomes: DataFrame, revisions: DataFrame) -> DataFrame:
    """Completions and whether a full-window outcome of their revision was there before.

    ``events`` are sequenced (with revision). Of the outcomes only the first full-window one per
    action and revision matters, so the join meets one row per key."""
    whole = (F.col("window_start") == F.col("measurement_start")) & (F.col("window_end") == F.col("measurement_end"))
    first = _with_plan(outcomes, revisions).where(whole).groupBy("action_id", "revision").agg(F.min("created_at").alias("_reviewed"))
    done = events.where("status = 'completed'").join(first, ["action_id", "revision"], "left")
    return done.select("action_id", "event_id", "sequence", "revision", F.coalesce(F.col("_reviewed") <= F.col("created_at"), F.lit(False)).alias("allowed"))


# ---------------------------------------------------------------- E06
def outcome_reviews(outcomes: DataFrame, revisions: DataFrame, proposals: DataFrame) -> DataFrame:
    """Recorded values against the plan of the revision they were recorded under.

    Descriptive only: reaching a threshold says nothing about the cause."""
    c = F.col
    value = F.element_at("metrics", c("primary_metric"))
    lower = [m for m, (way, _, _) in METRICS.items() if way == "lower"]
    met = F.when(c("primary_metric").isin(lower), value <= c("target")).otherwise(value >= c("target"))
    service = (F.element_at("metrics", F.lit("satisfaction_score")) >= c("satisfaction_min")) & (F.element_at("metrics", F.lit("late_delivery_pct")) <= c("late_delivery_max"))
    kinds = F.create_map(*(F.lit(x) for kv in OUTCOME_KINDS.items() for x in kv))
    before = F.create_map(*(x for m in METRICS for x in (F.lit(m), c(f"_b.{m}").cast("double"))))
    base = proposals.select("action_id", F.struct(*METRICS).alias("_b"))
    rows = _with_plan(outcomes, revisions).join(base, "action_id", "left")
    return rows.select(
        "outcome_id", "action_id", "revision", "primary_metric", value.alias("recorded_value"), "target",
        met.alias("target_met"), service.alias("guardrails_met"),
        ((c("window_start") == c("measurement_start")) & (c("window_end") == c("measurement_end"))).alias("window_complete"),
        F.element_at(kinds, c("kind")).alias("classification"),
        F.element_at(before, c("primary_metric")).alias("baseline_value"),
    )


# ---------------------------------------------------------------- E08, E02, W10
def register(events: DataFrame, revisions: DataFrame, outcomes: DataFrame, proposals: DataFrame) -> DataFrame:
    """One row per action: site, month, status, latest revision with owner and estimate, outcomes.

    The estimate is the change of profit that the latest revision's levers give on the frozen
    baseline; it is conditional, and estimates of several actions must not be added up."""
    state = events.groupBy("action_id").agg(
        F.max_by("status", F.struct("created_at", "event_id")).alias("status"), F.count(F.lit(1)).alias("events")
    )
    newest = revisions.groupBy("action_id").agg(F.max_by(F.struct("revision", "owner", *LEVERS), "revision").alias("_r"))
    found = outcomes.groupBy("action_id").agg(F.count(F.lit(1)).alias("outcomes"))
    rows = proposals.join(state, "action_id", "left").join(newest, "action_id", "left").join(found, "action_id", "left")
    rows = outcome(rows, lambda k: F.col(f"_r.{k}") if k in LEVERS else F.lit(None).cast("double"), "_after")
    return rows.select(
        "action_id", "restaurant_id", "restaurant_name", F.col("period").alias("baseline_month"), "status",
        F.col("status").isin(list(TERMINAL)).alias("is_closed"), "events", F.col("_r.revision").alias("revision"),
        F.col("_r.owner").alias("owner"), (F.col("_after.operating_profit") - F.col("operating_profit")).alias("scenario_profit_delta"),
        F.coalesce("outcomes", F.lit(0)).alias("outcomes"),
    )
