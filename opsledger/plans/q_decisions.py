"""Decision queries: scenario grid, bridges, weekly scorecard and brief."""

from __future__ import annotations

from ..operators import management, scenarios
from ..operators.scenarios import OUTPUTS, Scenario
from .oracle_base import cte, snap, typed, with_ctes
from .registry import query

GRID = [
    Scenario(name="Baseline"),
    Scenario(name="Staffing and wage +10%, 20% discount", hours_change=0.10, wage_change=0.10, discount_rate=0.20),
    Scenario(name="Demand -10%", demand_change=-0.10),
    Scenario(name="Waste 10%", waste_rate=0.10),
]
KEYS = ["restaurant_id", "month"]
SIM_SPEC = "restaurant_id:i, month:s, scenario:s, " + ", ".join(f"{o}:d" for o in OUTPUTS) + ", is_valid:b, invalid_reason:s"


def _sql_lit(v) -> str:
    return "NULL::DOUBLE" if v is None else f"{float(v)}::DOUBLE"


def _grid_sql(grid: list[Scenario]) -> str:
    rows = ", ".join(
        f"('{s.name}', {_sql_lit(s.hours_change)}, {_sql_lit(s.wage_change)}, {_sql_lit(s.price_change)}, "
        f"{_sql_lit(s.demand_change)}, {_sql_lit(s.discount_rate)}, {_sql_lit(s.waste_rate)})"
        for s in grid
    )
    return f"(VALUES {rows}) g(scenario, hc, wc, pc, dc, dov, wov)"


def sim_sql(grid: list[Scenario]) -> str:
    """Scenario formulas in SQL, written from the documented ledger identities."""
    _s = snap
    return f"""WITH b AS (
  SELECT k.restaurant_id, k.month, k.revenue, k.discounts, k.transactions, k.ingredient_cost, k.waste_cost,
         k.labour_cost, k.paid_hours, k.commission_cost, k.overhead_cost, k.campaign_cost, g.*,
         coalesce(g.dov, k.discounts / nullif(k.revenue + k.discounts, 0)) AS d,
         coalesce(g.wov, CASE WHEN k.ingredient_cost + k.waste_cost <> 0
                              THEN k.waste_cost / (k.ingredient_cost + k.waste_cost) ELSE 0.0 END) AS w
  FROM store_month_kpis k, {_grid_sql(grid)}),
v AS (
  SELECT *, CASE
    WHEN NOT coalesce(revenue >= 0 AND discounts >= 0 AND transactions >= 0 AND ingredient_cost >= 0
         AND waste_cost >= 0 AND labour_cost >= 0 AND paid_hours >= 0 AND commission_cost >= 0
         AND overhead_cost >= 0 AND campaign_cost >= 0
         AND NOT isnan(revenue) AND NOT isnan(overhead_cost), false)
      THEN 'ledger inputs must be present, finite and not negative'
    WHEN NOT coalesce(revenue > 0 AND transactions > 0 AND paid_hours > 0, false)
      THEN 'revenue, orders and paid hours must be above zero'
    WHEN NOT (hc > -1 AND hc <= 2) THEN 'hours_change must lie in (-1, 2]'
    WHEN NOT (wc > -1 AND wc <= 2) THEN 'wage_change must lie in (-1, 2]'
    WHEN NOT (pc > -1 AND pc <= 2) THEN 'price_change must lie in (-1, 2]'
    WHEN NOT (dc > -1 AND dc <= 2) THEN 'demand_change must lie in (-1, 2]'
    WHEN NOT coalesce(d >= 0 AND d < 1, false) THEN 'discount_rate must lie in [0, 1)'
    WHEN NOT coalesce(w >= 0 AND w < 1, false) THEN 'waste_rate must lie in [0, 1)'
  END AS invalid_reason FROM b),
c AS (
  SELECT *, invalid_reason IS NULL AS ok,
         transactions * (1 + dc) AS n1,
         (revenue + discounts) * (1 + dc) * (1 + pc) AS gross,
         (revenue + discounts) * (1 + dc) * (1 + pc) * (1 - d) AS rev1,
         ingredient_cost * (1 + dc) AS ing1,
         ingredient_cost * (1 + dc) * w / (1 - w) AS waste1,
         paid_hours * (1 + hc) AS hours1,
         labour_cost / paid_hours * (1 + wc) AS wage1
  FROM v),
e AS (
  SELECT *, hours1 * wage1 AS lab1, rev1 * commission_cost / revenue AS com1, ing1 + waste1 AS cogs1 FROM c),
f AS (
  SELECT *, rev1 - cogs1 - com1 - lab1 - campaign_cost AS contrib1,
         rev1 / n1 - (cogs1 + com1) / n1 AS unit1, lab1 + overhead_cost + campaign_cost AS fixed1 FROM e)
SELECT restaurant_id, month, scenario,
  {_s('CASE WHEN ok THEN rev1 END')} AS revenue, {_s('CASE WHEN ok THEN gross * d END')} AS discounts,
  {_s('CASE WHEN ok THEN n1 END')} AS transactions, {_s('CASE WHEN ok THEN ing1 END')} AS ingredient_cost,
  {_s('CASE WHEN ok THEN waste1 END')} AS waste_cost, {_s('CASE WHEN ok THEN cogs1 END')} AS cogs,
  {_s('CASE WHEN ok THEN hours1 END')} AS paid_hours, {_s('CASE WHEN ok THEN wage1 END')} AS loaded_hourly_wage,
  {_s('CASE WHEN ok THEN lab1 END')} AS labour_cost, {_s('CASE WHEN ok THEN com1 END')} AS commission_cost,
  {_s('CASE WHEN ok THEN campaign_cost END')} AS campaign_cost, {_s('CASE WHEN ok THEN overhead_cost END')} AS overhead_cost,
  {_s('CASE WHEN ok THEN contrib1 END')} AS operating_contribution,
  {_s('CASE WHEN ok THEN contrib1 - overhead_cost END')} AS operating_profit,
  {_s('CASE WHEN ok THEN (contrib1 - overhead_cost) / rev1 END')} AS operating_margin_pct,
  {_s('CASE WHEN ok AND unit1 > 0 THEN fixed1 / unit1 END')} AS break_even_orders,
  {_s('CASE WHEN ok AND unit1 > 0 THEN fixed1 / unit1 * (rev1 / n1) END')} AS break_even_revenue,
  {_s('CASE WHEN ok THEN d END')} AS discount_rate, {_s('CASE WHEN ok THEN w END')} AS waste_rate,
  ok AS is_valid, invalid_reason
FROM f"""


@query("x01_scenario_grid", typed(with_ctes(["store_month_kpis"], sim_sql(GRID)), SIM_SPEC))
def x01_scenario_grid(ctx):
    """Scenario grid over every site-month ledger with input validation."""
    return scenarios.simulate(ctx.store_month_kpis, GRID, KEYS)


SENS = scenarios.sensitivity(Scenario(name="Price +5%", price_change=0.05, demand_change=-0.02), 0.10)


@query("x04_demand_sensitivity", typed(with_ctes(["store_month_kpis"], sim_sql(SENS)), SIM_SPEC))
def x04_demand_sensitivity(ctx):
    """Downside / Central / Upside demand cases of one scenario."""
    return scenarios.simulate(ctx.store_month_kpis, SENS, KEYS)


_CMP = Scenario(name="Scenario", hours_change=0.10, wage_change=0.10, discount_rate=0.20)
_UNPIVOT = "\nUNION ALL\n".join(
    f"SELECT b.restaurant_id, b.month, '{o}' AS metric, b.{o} AS baseline, s.{o} AS scenario, s.{o} - b.{o} AS delta "
    f"FROM sims b JOIN sims s ON b.restaurant_id = s.restaurant_id AND b.month = s.month "
    f"AND b.scenario = 'Baseline' AND s.scenario = 'Scenario'"
    for o in OUTPUTS
)


@query(
    "x03_scenario_compare",
    typed(
        with_ctes(["store_month_kpis"], f"WITH sims AS ({sim_sql([Scenario(name='Baseline'), _CMP])})\n{_UNPIVOT}"),
        "restaurant_id:i, month:s, metric:s, baseline:d, scenario:d, delta:d",
    ),
)
def x03_scenario_compare(ctx):
    """Baseline / scenario / delta long table per site-month."""
    return scenarios.compare(ctx.store_month_kpis, _CMP, KEYS)


_COSTS = ["ingredient_cost", "waste_cost", "labour_cost", "commission_cost", "overhead_cost", "campaign_cost"]
_LAGS = ", ".join(f"lag({c}) OVER w AS prior_{c}" for c in ["revenue", "transactions", "operating_profit"] + _COSTS)
_DRIVERS = [
    ("Order volume", "(transactions - prior_transactions) * (prior_revenue / prior_transactions)"),
    ("Basket value (net)", "(revenue / transactions - prior_revenue / prior_transactions) * transactions"),
] + [(c.replace("_", " ").title(), f"coalesce(prior_{c}, 0.0) - coalesce({c}, 0.0)") for c in _COSTS]
_TOTAL = " + ".join(f"({e})" for _, e in _DRIVERS)
BRIDGE_SQL = f"""WITH l AS (
  SELECT restaurant_id, month, revenue, transactions, operating_profit, {', '.join(_COSTS)},
         {_LAGS}, lag(month) OVER w AS prior_period
  FROM store_month_kpis WINDOW w AS (PARTITION BY restaurant_id ORDER BY month)),
p AS (SELECT *, operating_profit - prior_operating_profit AS profit_change,
             coalesce(transactions > 0 AND prior_transactions > 0, false) AS ok FROM l WHERE prior_period IS NOT NULL),
t AS (SELECT *, CASE WHEN ok THEN abs({_TOTAL} - profit_change) <= 0.010000001 END AS reconciles FROM p)
{chr(10).join(('UNION ALL ' if i else '') + f"SELECT restaurant_id, month, prior_period, {i} AS step, '{n}' AS driver, CASE WHEN ok THEN {e} END AS amount, profit_change, reconciles, CASE WHEN NOT ok THEN 'no orders' WHEN reconciles THEN 'reconciled' ELSE 'not reconciled' END AS status FROM t" for i, (n, e) in enumerate(_DRIVERS))}"""


@query(
    "x06_profit_bridges",
    typed(
        with_ctes(["store_month_kpis"], BRIDGE_SQL),
        "restaurant_id:i, month:s, prior_period:s, step:i, driver:s, amount:d, profit_change:d, reconciles:b, status:s",
    ),
)
def x06_profit_bridges(ctx):
    """Profit bridge of every site-month from the month before, closed months kept."""
    return management.period_bridges(ctx.store_month_kpis, "restaurant_id", "month")


# ---------------------------------------------------------------- weekly scorecard
from ..operators import kpi  # noqa: E402
from .oracle_base import msum  # noqa: E402

_SUMS = ", ".join(f"{msum(c) if c in kpi.MONEY else f'sum({c})'} AS {c}" for c in kpi.ADDITIVE)
_RATES = """revenue / nullif(transactions, 0) AS average_transaction_value,
       operating_profit / nullif(revenue, 0) AS operating_margin_pct,
       labour_cost / nullif(revenue, 0) AS labour_cost_pct,
       waste_cost / nullif(ingredient_cost + waste_cost, 0) AS waste_pct"""
CARD_SQL = f"""WITH e AS (SELECT max(business_date) AS d FROM store_day_ledger),
w AS (SELECT s.*, CASE WHEN s.business_date >= (SELECT d FROM e) - 6 THEN 'current' ELSE 'previous' END AS period,
             t.revenue_target, t.revenue_target / day(last_day(s.business_date)) AS allocated_revenue_target
      FROM store_day_ledger s LEFT JOIN targets t USING (restaurant_id, month)
      WHERE s.business_date BETWEEN (SELECT d FROM e) - 13 AND (SELECT d FROM e)),
g AS (SELECT restaurant_id, period, {_SUMS}, sum(allocated_revenue_target) AS allocated_revenue_target,
             count(DISTINCT business_date) AS days, count(*) FILTER (WHERE revenue_target IS NULL) AS missing_targets
      FROM w GROUP BY restaurant_id, period),
r AS (SELECT *, {_RATES} FROM g)
SELECT n.restaurant_id, n.restaurant_name, (SELECT d FROM e) - 6 AS window_start, (SELECT d FROM e) AS window_end,
       coalesce(c.days = 7 AND p.days = 7 AND c.missing_targets + p.missing_targets = 0, false) AS complete,
       c.revenue, p.revenue AS prior_revenue, c.operating_profit, p.operating_profit AS prior_operating_profit,
       c.operating_margin_pct, p.operating_margin_pct AS prior_operating_margin_pct,
       c.labour_cost_pct, p.labour_cost_pct AS prior_labour_cost_pct,
       c.revenue - p.revenue AS revenue_change, c.operating_profit - p.operating_profit AS profit_change,
       (c.revenue - p.revenue) / nullif(p.revenue, 0) AS revenue_growth,
       c.allocated_revenue_target, c.revenue - c.allocated_revenue_target AS target_gap,
       c.revenue / nullif(c.allocated_revenue_target, 0) AS target_achievement_pct,
       {', '.join(f'c.{x} AS {x}, p.{x} AS prior_{x}' for x in ['ingredient_cost', 'waste_cost', 'labour_cost', 'commission_cost', 'overhead_cost', 'campaign_cost'])}
FROM restaurants n LEFT JOIN r c ON n.restaurant_id = c.restaurant_id AND c.period = 'current'
LEFT JOIN r p ON n.restaurant_id = p.restaurant_id AND p.period = 'previous'"""
_CARD_COLS = (
    "restaurant_id restaurant_name window_start window_end complete revenue prior_revenue operating_profit prior_operating_profit "
    "operating_margin_pct prior_operating_margin_pct labour_cost_pct prior_labour_cost_pct revenue_change "
    "profit_change revenue_growth allocated_revenue_target target_gap target_achievement_pct"
).split() + [f"{p}{x}" for x in ["ingredient_cost", "waste_cost", "labour_cost", "commission_cost", "overhead_cost", "campaign_cost"] for p in ("", "prior_")]
CARD_SPEC = ", ".join(
    f"{c}:{ {'restaurant_id': 'i', 'restaurant_name': 's', 'window_start': 't', 'window_end': 't', 'complete': 'b'}.get(c, 'd') }" for c in _CARD_COLS
)
cte("weekly_card", ["store_day_ledger", "targets", "restaurants"], CARD_SQL)


def _card(ctx):
    return management.weekly_scorecard(ctx.store_day, ctx.targets, ctx.restaurants)


@query("x07_weekly_scorecard", typed(with_ctes(["weekly_card"], "SELECT * FROM weekly_card"), CARD_SPEC))
def x07_weekly_scorecard(ctx):
    """Current vs previous complete 7-day window per site, prorated targets."""
    return _card(ctx).select(*_CARD_COLS)


_COST_STRUCTS = ", ".join(
    f"({snap(f'{c} - prior_{c}')}, {-i}, '{c}')" for i, c in enumerate(
        ["ingredient_cost", "waste_cost", "labour_cost", "commission_cost", "overhead_cost", "campaign_cost"])
)
def _MONEY_TEXT(c: str) -> str:
    """Signed whole amount with thousands separators."""
    return f"(CASE WHEN round_even({c}, 0) < 0 THEN '-' ELSE '+' END || format('{{:,}}', CAST(round_even(abs({c}), 0) AS BIGINT)))"


BRIEF_SQL = f"""WITH b AS (
  SELECT *, list_max([{_COST_STRUCTS}]) AS top,
         CASE WHEN prior_ingredient_cost + prior_waste_cost <> 0
              THEN prior_waste_cost / (prior_ingredient_cost + prior_waste_cost) END AS pw
  FROM weekly_card),
c AS (
  SELECT *, CASE WHEN pw IS NOT NULL AND pw < 1 THEN greatest(0.0, waste_cost - ingredient_cost * pw / (1 - pw)) ELSE 0.0 END AS excess_waste,
         greatest(0.0, labour_cost - revenue * prior_labour_cost_pct) AS labour_share_gap FROM b),
d AS (SELECT *, coalesce(excess_waste >= labour_share_gap AND excess_waste > 0, false) AS waste_first FROM c)
SELECT restaurant_id, restaurant_name, window_start, window_end, complete,
       'Revenue ' || {_MONEY_TEXT('revenue_change')} || ', operating profit ' || {_MONEY_TEXT('profit_change')} || ' on the week before.' AS what_changed,
       revenue_change, profit_change, operating_margin_pct, target_achievement_pct,
       top[3] AS cost_driver, top[1] AS cost_driver_change, replace(top[3], '_', ' ') || ' ' || {_MONEY_TEXT('top[1]')} AS evidence,
       excess_waste, labour_share_gap,
       {', '.join(f"CASE WHEN waste_first THEN '{management.PLAYS['waste'][k]}' ELSE '{management.PLAYS['labour'][k]}' END AS {k}" for k in management.PLAYS['waste'])},
       CASE WHEN waste_first THEN excess_waste ELSE labour_share_gap END AS estimated_weekly_opportunity,
       CASE WHEN target_gap < 0 OR operating_margin_pct < 0.10 THEN 'High' ELSE 'Review' END AS priority
FROM d"""


@query(
    "x08_weekly_brief",
    typed(
        with_ctes(["weekly_card"], BRIEF_SQL),
        "restaurant_id:i, restaurant_name:s, window_start:t, window_end:t, complete:b, what_changed:s, revenue_change:d, "
        "profit_change:d, operating_margin_pct:d, target_achievement_pct:d, cost_driver:s, cost_driver_change:d, "
        "evidence:s, excess_waste:d, labour_share_gap:d, recommended_action:s, proposed_owner:s, impact_basis:s, "
        "success_measure:s, estimated_weekly_opportunity:d, priority:s",
    ),
)
def x08_weekly_brief(ctx):
    """Weekly decision register: adverse cost driver, opportunity, action, priority."""
    return management.weekly_brief(_card(ctx))
