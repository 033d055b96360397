"""Hand-computed values for scenario, bridge, allocation and null semantics."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from opsledger.functions.semantics import clamp, ratio
from opsledger.operators import management, marts, scenarios
from opsledger.operators.scenarios import Scenario

#: A month of 160 orders at 50 each, worked out by hand below.
LEDGER = dict(
    revenue=8000.0, discounts=400.0, transactions=160.0, ingredient_cost=2400.0, waste_cost=160.0,
    labour_cost=2000.0, paid_hours=80.0, commission_cost=480.0, overhead_cost=900.0, campaign_cost=60.0,
)


def _ledger(spark, **over):
    row = {"restaurant_id": 1, "month": "2025-01", **LEDGER, **over}
    return spark.createDataFrame([row])


def _sim(spark, s, **over):
    return scenarios.simulate(_ledger(spark, **over), [s], ["restaurant_id", "month"]).first().asDict()


def test_no_lever_gives_the_ledger_back(spark):
    r = _sim(spark, Scenario())
    assert r["cogs"] == pytest.approx(2560)  # 2400 + 160
    assert r["operating_contribution"] == pytest.approx(2900)  # 8000 - 2560 - 2000 - 480 - 60
    assert r["operating_profit"] == pytest.approx(2000)  # less 900 overheads


def test_levers_act_together(spark):
    r = _sim(spark, Scenario(hours_change=0.25, wage_change=0.20, discount_rate=0.25))
    assert r["revenue"] == pytest.approx(6300)  # 8400 at list price, a quarter off
    assert r["labour_cost"] == pytest.approx(3000)  # 100 hours at 30
    # commission keeps its share of net sales, 6 percent: 378
    assert r["operating_profit"] == pytest.approx(-598)


def test_waste_share_is_of_ingredients_and_waste(spark):
    assert _sim(spark, Scenario(waste_rate=0.20))["waste_cost"] == pytest.approx(600)  # 600 of 3000


def test_no_break_even_below_unit_cost(spark):
    assert _sim(spark, Scenario(discount_rate=0.85))["break_even_orders"] is None  # 7.88 an order, 16 of goods


def test_invalid_baseline_is_flagged(spark):
    r = _sim(spark, Scenario(), revenue=0.0)
    assert r["is_valid"] is False and r["revenue"] is None


def test_bridge_from_fifty_to_fifty_five_an_order(spark):
    first = {"restaurant_id": 1, "month": "2025-01", **LEDGER, "operating_profit": 2000.0}
    second = {**first, "month": "2025-02", "revenue": 9900.0, "transactions": 180.0, "labour_cost": 2300.0, "operating_profit": 3600.0}
    bridge = management.period_bridges(spark.createDataFrame([first, second]), "restaurant_id", "month").toPandas()
    amount = bridge.set_index("driver").amount
    assert amount["Order volume"] == pytest.approx(1000)  # 20 more orders at 50
    assert amount["Basket value (net)"] == pytest.approx(900)  # 180 orders at 5 more
    assert bridge.amount.sum() == pytest.approx(1600)  # less 300 of labour
    assert bridge.reconciles.all()


def test_shift_hours_follow_the_clock(spark):
    half_past = dt.datetime(2025, 6, 3, 12, 30)
    shifts = spark.createDataFrame(
        [(4, dt.date(2025, 6, 3), role, half_past, dt.datetime(2025, 6, 3, 16), 3.0, 28.0) for role in ("Kitchen", "Service")],
        "restaurant_id int, business_date date, role string, actual_start timestamp_ntz, "
        "actual_end timestamp_ntz, paid_hours double, hourly_cost double",
    )
    got = {r.hour: (r.paid_hours, r.service_hours) for r in marts.hourly_capacity(shifts).collect() if r.paid_hours > 0}
    assert sorted(got) == [12, 13, 14, 15]
    # 3 paid of 3.5 clock hours: six sevenths of an hour, half of it in the first
    assert got[12] == (pytest.approx(6 / 7, abs=1e-5), pytest.approx(3 / 7, abs=1e-5))
    assert got[15] == (pytest.approx(12 / 7, abs=1e-5), pytest.approx(6 / 7, abs=1e-5))
    assert sum(p for p, _ in got.values()) == pytest.approx(6.0, abs=1e-5)


def test_ratio_and_clamp_keep_nulls(spark):
    df = spark.createDataFrame([(1.0, 0.0), (None, 2.0)], "a double, b double")
    out = df.select(ratio("a", "b").alias("r"), clamp(F.col("a") * 200, 0, 100).alias("c")).collect()
    assert out[0]["r"] is None and out[1]["r"] is None
    assert out[0]["c"] == 100 and out[1]["c"] is None
