"""The cleaning flow feeds the marts; hard failures, closed months, shift hours, stored marts."""

import datetime as dt
import os
import shutil
import tempfile

import pytest
from conftest import SF
from pyspark.sql import functions as F

from opsledger.operators import actions, forecast, management, marts, planning, quality
from opsledger.plans import context
from opsledger.sources.adapters import Source


# ---------------------------------------------------------------- cleaning feeds the marts
def test_marts_hold_only_lines_of_clean_orders(ctx):
    flagged = ctx.flagged
    bad = {r[0] for r in flagged.where("_invalid AND order_id IS NOT NULL").select("order_id").distinct().collect()}
    kept = {r[0] for r in ctx.transactions.select("order_id").distinct().collect()}
    assert bad and kept and not bad & kept
    assert {r[0] for r in ctx.orders.select("order_id").collect()} == kept
    clean = flagged.where("order_id IS NOT NULL").agg(F.countDistinct("order_id")).first()[0] - len(bad)
    assert len(kept) == clean
    assert ctx.delivery.where(~F.col("order_id").isin(list(kept))).count() == 0
    assert ctx.loyalty.where(F.col("order_id").isNotNull() & ~F.col("order_id").isin(list(kept))).count() == 0
    assert ctx.waste.where("waste_units < 0").count() == 0
    assert ctx.customer_feedback.where("overall_score NOT BETWEEN 1 AND 5").count() == 0
    assert ctx.labour.where("hourly_cost IS NULL").count() == 0 and ctx.labour.where("rate_imputed = 1").count() > 0


def test_summary_is_the_split(ctx):
    clean, rejected = quality.quarantine_orders(ctx.flagged)
    s = quality.quality_summary(ctx.flagged).first()
    assert (s.clean_lines, s.raw_lines_after_dedup) == (clean.count(), clean.count() + rejected.count())
    assert s.clean_revenue == pytest.approx(clean.agg(F.sum("net_revenue")).first()[0])


def test_hard_failures(ctx, spark):
    with pytest.raises(ValueError, match="site master"):
        quality.require_known_sites(ctx.raw_labour.withColumn("restaurant_id", F.lit(999)), ctx.restaurants, "labour")
    with pytest.raises(ValueError, match="no paid hours"):
        quality.require_recoverable_shifts(ctx.raw_labour.withColumn("break_hours", F.lit(30.0)))
    none = quality.repair_labour(ctx.raw_labour.withColumn("hourly_cost", F.lit(None).cast("double")), ctx.restaurants, ctx.calendar)
    with pytest.raises(ValueError, match="without a rate"):
        quality.require_rates(none)
    twice = ctx.restaurants.unionByName(ctx.restaurants)
    with pytest.raises(ValueError, match="not unique"):
        quality.finish_clean_lines(quality.quarantine_orders(ctx.flagged)[0], twice)


def test_class_medians_equal_the_median(spark):
    rows = [("a", x) for x in (5.0, 1.0, 1.0, 9.0)] + [("b", x) for x in (2.0, 8.0, 3.0)] + [("c", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r._median_rate for r in quality.class_medians(df, ["k"], "v").collect()}
    want = {r.k: r.m for r in df.where("v IS NOT NULL").groupBy("k").agg(F.median("v").alias("m")).collect()}
    assert got == want


def test_line_ids_of_an_order_with_many_lines(spark):
    base = Source(spark, SF)
    line = base.t("lineitem").limit(1)
    many = line.withColumn("l_linenumber", F.explode(F.sequence(F.lit(1), F.lit(1200)))).withColumn("l_orderkey", F.lit(7).cast("long"))
    after = many.limit(3).withColumn("l_orderkey", F.lit(8).cast("long"))

    class Two(Source):
        def t(self, name):
            return many.unionByName(after) if name == "lineitem" else super().t(name)

    ids = Two(spark, SF).lines().select("transaction_line_id")
    assert ids.distinct().count() == 1203


# ---------------------------------------------------------------- shift hours
def _shift(spark, start, end, paid):
    day = dt.date(2024, 5, 1)
    row = (1, day, start, end, paid)
    return spark.createDataFrame([row], "restaurant_id long, business_date date, s timestamp_ntz, e timestamp_ntz, paid double")


@pytest.mark.parametrize(
    "start,end,paid,want",
    [
        ((1, 20, 0), (2, 2, 0), 6.0, {20: 1.0, 21: 1.0}),  # past midnight: the trading hours it covers
        ((1, 13, 0), (1, 13, 0), 0.0, {13: 0.0}),  # no length
        ((1, 10, 30), (1, 12, 0), 1.5, {11: 1.0, 12: 0.0}),
        ((1, 22, 0), (2, 1, 0), 3.0, {}),
    ],
)
def test_hours_of_a_shift(spark, start, end, paid, want):
    at = lambda x: dt.datetime(2024, 5, *x)
    got = marts.allocate_hours(_shift(spark, at(start), at(end), paid), "s", "e", F.col("paid")).collect()
    assert {r.hour: pytest.approx(r.paid_alloc) for r in got} == want


# ---------------------------------------------------------------- bridges and scorecard keep every site
def test_bridge_over_a_closed_month(spark):
    costs = ", ".join(f"{c} double" for c in marts.COSTS)
    zero = (0.0,) * len(marts.COSTS)
    rows = [(1, "2024-01", 100.0, 10, 100.0, *zero), (1, "2024-02", 0.0, 0, 0.0, *zero), (1, "2024-03", 90.0, 9, 90.0, *zero)]
    ledger = spark.createDataFrame(rows, f"site long, month string, revenue double, transactions long, operating_profit double, {costs}")
    out = management.period_bridges(ledger, "site", "month").collect()
    assert {(r.month, r.status) for r in out} == {("2024-02", "no orders"), ("2024-03", "no orders")}
    assert all(r.amount is None and r.reconciles is None for r in out) and len(out) == 16


def test_scorecard_keeps_a_site_without_a_window(ctx):
    end = ctx.store_day.agg(F.max("business_date")).first()[0]
    gone = ctx.store_day.where(~((F.col("restaurant_id") == 3) & (F.col("business_date") > F.lit(end - dt.timedelta(days=7)))))
    card = {r.restaurant_id: r for r in management.weekly_scorecard(gone, ctx.targets, ctx.restaurants).collect()}
    assert len(card) == ctx.restaurants.count()
    assert not card[3].complete and card[3].revenue is None and card[3].prior_revenue is not None
    assert card[3].window_start == end - dt.timedelta(days=6) and card[3].restaurant_name


# ---------------------------------------------------------------- fingerprints (E07) and errors
def test_fingerprint_notices_every_field(ctx):
    events = ctx.action_events
    stored = actions.fingerprints(events).cache()
    one = events.orderBy("event_id").first()
    edits = {
        "value": F.col("value") + 8.0,
        "note": F.concat(F.col("note"), F.lit("|")),
        "status": F.lit("cancelled") if one.status != "cancelled" else F.lit("approved"),
        "created_at": F.col("created_at") + F.expr("INTERVAL 1 MICROSECOND"),
    }
    for c, edit in edits.items():
        now = events.withColumn(c, F.when(F.col("event_id") == one.event_id, edit).otherwise(F.col(c)))
        state = {r.action_id: r.state for r in actions.verify_fingerprints(stored, now).collect()}
        assert [a for a, s in state.items() if s != "intact"] == [one.action_id], c
    twice = events.unionByName(events.where(F.col("event_id") == one.event_id))
    assert actions.verify_fingerprints(stored, twice).where("state = 'altered'").count() == 1
    less = events.where(F.col("action_id") != one.action_id)
    assert [r.action_id for r in actions.verify_fingerprints(stored, less).where("state = 'missing'").collect()] == [one.action_id]


def test_errors_are_not_rounded(spark):
    df = spark.createDataFrame([("m", 1.0, 1.004), ("m", 2.0, 2.0041)], "model string, actual_revenue double, forecast_revenue double")
    r = forecast.metrics(df, ["model"]).first()
    assert r.mae == pytest.approx(0.00405) and r.wape == pytest.approx(0.0081 / 3 * 100)


# ---------------------------------------------------------------- stored marts
def test_a_changed_input_file_makes_new_marts(spark):
    folder = tempfile.mkdtemp(prefix="opsledger-input-")
    for name in os.listdir(SF):
        shutil.copy(os.path.join(SF, name), folder)
    before = context.fingerprint(spark, folder)
    assert before == context.fingerprint(spark, folder) == context.fingerprint(spark, f"file://{folder}")
    os.utime(os.path.join(folder, "orders.parquet"), (1, 1))
    assert context.fingerprint(spark, folder) != before


def test_planning_levers_name_every_fault():
    with pytest.raises(ValueError) as e:
        planning.PlanningAssumptions(utilisation=2, minimum_service_staff=1.5).validate()
    assert "utilisation" in str(e.value) and "minimum_service_staff" in str(e.value)


# ---------------------------------------------------------------- order of the business answers
def test_answers_come_in_order(ctx):
    from opsledger.plans import registry

    registry.load_all()
    run = lambda q: registry.QUERIES[q](ctx.spark, SF).collect()
    for q in ("a16_support_needed", "a18_daypart_productivity", "a19_late_share"):
        assert [r.position for r in run(q)] == sorted(r.position for r in run(q))
    products = run("a17_product_contribution")
    assert products == sorted(products, key=lambda r: (-r.gross_contribution, r.category, r.product_name))
    for q in ("a15_kpi_sql", "a21_target_yoy"):
        rows = [(r.restaurant_id, r.month) for r in run(q)]
        assert rows == sorted(rows)


def test_contracts_and_profiles_cover_every_table(ctx):
    """Every table is judged; counts equal those of plain pandas (Q12, Q13)."""
    from opsledger.plans import q_quality as q

    checks = {(r.tbl, r.rule): r.invalid_rows for r in q.q12_table_contracts(ctx).collect()}
    missing = {(r.tbl, r.col): (r.missing_rows, r.total_rows) for r in q.q13_table_profiles(ctx).collect()}
    assert {t for t, _ in checks} == {t for t, _ in missing} == set(q.TABLES)
    for name, (source, keys) in q.TABLES.items():
        d = getattr(ctx, source).toPandas()
        for c in d.columns:
            if (name, c) in missing:
                assert missing[name, c] == (d[c].isna().sum(), len(d)), (name, c)
        d = d.drop_duplicates()
        assert checks[name, "Unique primary key"] == d.duplicated(keys).sum(), name
        for m in (c for c in d.columns if c in q.MONEY):
            assert checks[name, f"Valid {m}"] == (~(d[m] >= 0)).sum(), (name, m)
    assert checks["labour", "Valid hourly_cost"] > 0 and missing["customer_feedback", "overall_score"][0] > 0
    old = {(r.tbl, r.rule): r.invalid_rows for r in q.q12_contract_checks(ctx).collect()}
    assert all(checks[k] == n for k, n in old.items())
