"""Promotion queries: day-aligned counterfactual, contribution, bootstrap range,
campaign summary and economics view (M02-M04, M06, A30)."""

from __future__ import annotations

from ..operators import promotions
from .oracle_base import cte, typed, with_ctes
from .q_analysis import CONTROL_SQL
from .registry import query

# The oracle enumerates every control site explicitly (the Spark operator
# subtracts excluded sites from peer-group totals instead).
cte("m01_controls", ["promotions", "restaurants"], CONTROL_SQL)
cte(
    "campaign_days",
    ["promotions", "restaurants", "store_day_ledger"],
    """WITH c AS (SELECT p.*, r.location_type FROM promotions p JOIN restaurants r USING (restaurant_id)),
ctrl AS (
  SELECT c.promotion_id, r.restaurant_id AS other_id FROM c JOIN restaurants r
    ON r.location_type = c.location_type AND r.restaurant_id <> c.restaurant_id
  WHERE NOT EXISTS (SELECT 1 FROM promotions o WHERE o.restaurant_id = r.restaurant_id
                    AND o.start_date <= c.end_date AND o.end_date >= c.start_date - 14)),
n AS (SELECT promotion_id, count(*) AS control_stores FROM ctrl GROUP BY promotion_id),
peer AS (
  SELECT ctrl.promotion_id, s.business_date, sum(CAST(round(s.revenue * 100) AS BIGINT)) AS rev_c,
         sum(s.transactions) AS tx
  FROM ctrl JOIN c USING (promotion_id)
  JOIN store_day_ledger s ON s.restaurant_id = ctrl.other_id
   AND s.business_date BETWEEN c.start_date - 14 AND c.end_date
  GROUP BY ctrl.promotion_id, s.business_date),
dd AS (SELECT c.promotion_id, c.restaurant_id, CAST(k AS INTEGER) AS k, CAST(c.start_date + CAST(k AS INTEGER) AS DATE) AS d,
              CAST(c.start_date + CAST(k AS INTEGER) - 14 AS DATE) AS b
       FROM c, LATERAL generate_series(0, c.end_date - c.start_date) t(k)),
x AS (
  SELECT dd.promotion_id, dd.k, dd.d, n.control_stores,
         td.revenue AS observed_revenue, tb.revenue AS before_revenue,
         CAST(pb.rev_c AS DOUBLE) / 100.0 / n.control_stores AS peer_revenue_before,
         CAST(pn.rev_c AS DOUBLE) / 100.0 / n.control_stores AS peer_revenue_during,
         td.transactions AS observed_orders, tb.transactions AS before_orders,
         CAST(pb.tx AS DOUBLE) / n.control_stores AS peer_orders_before,
         CAST(pn.tx AS DOUBLE) / n.control_stores AS peer_orders_during,
         tb.ingredient_cost + tb.waste_cost + tb.commission_cost AS before_variable_cost,
         td.ingredient_cost + td.waste_cost + td.commission_cost AS observed_variable_cost,
         td.labour_cost - tb.labour_cost AS incremental_labour_cost
  FROM dd JOIN n USING (promotion_id)
  JOIN store_day_ledger td ON td.restaurant_id = dd.restaurant_id AND td.business_date = dd.d
  JOIN store_day_ledger tb ON tb.restaurant_id = dd.restaurant_id AND tb.business_date = dd.b
  JOIN peer pn ON pn.promotion_id = dd.promotion_id AND pn.business_date = dd.d
  JOIN peer pb ON pb.promotion_id = dd.promotion_id AND pb.business_date = dd.b),
y AS (
  SELECT *, peer_revenue_during / nullif(peer_revenue_before, 0) AS control_change,
         sum(before_variable_cost) OVER (PARTITION BY promotion_id)
           / nullif(sum(before_revenue) OVER (PARTITION BY promotion_id), 0) AS variable_cost_ratio
  FROM x),
z AS (
  SELECT *, before_revenue * control_change AS baseline_revenue,
         before_orders * peer_orders_during / nullif(peer_orders_before, 0) AS baseline_orders
  FROM y)
SELECT promotion_id, k AS campaign_day, d AS business_date, control_stores, observed_revenue, before_revenue,
       peer_revenue_before, peer_revenue_during, control_change, baseline_revenue,
       observed_revenue - baseline_revenue AS incremental_revenue, observed_orders, baseline_orders,
       observed_variable_cost, baseline_revenue * variable_cost_ratio AS baseline_variable_cost,
       incremental_labour_cost,
       (observed_revenue - baseline_revenue) - (observed_variable_cost - baseline_revenue * variable_cost_ratio)
         - incremental_labour_cost AS contribution_before_campaign
FROM z""",
)

DAY_SPEC = (
    "promotion_id:s, campaign_day:i, business_date:t, control_stores:i, observed_revenue:d, before_revenue:d, "
    "peer_revenue_before:d, peer_revenue_during:d, control_change:d, baseline_revenue:d, incremental_revenue:d, "
    "observed_orders:i, baseline_orders:d, observed_variable_cost:d, baseline_variable_cost:d, "
    "incremental_labour_cost:d, contribution_before_campaign:d"
)


@query("m02_counterfactual_days", typed(with_ctes(["campaign_days"], "SELECT * FROM campaign_days"), DAY_SPEC))
def m02_counterfactual_days(ctx):
    """Per campaign day: treated(d-14) x peer mean(d) / peer mean(d-14), deltas."""
    return _days(ctx)


def _defined(c: str) -> str:
    return f"CASE WHEN count(*) FILTER (WHERE {c} IS NULL) = 0 THEN sum({c}) END AS {c}"


cte(
    "promotion_effectiveness",
    ["m01_controls", "campaign_days"],
    f"""WITH a AS (
  SELECT promotion_id, count(*) AS aligned_days,
         {_defined('baseline_revenue')}, sum(observed_revenue) AS observed_revenue,
         {_defined('incremental_revenue')}, {_defined('baseline_orders')}, sum(observed_orders) AS observed_orders,
         {_defined('baseline_variable_cost')}, sum(observed_variable_cost) AS observed_variable_cost,
         sum(incremental_labour_cost) AS incremental_labour_cost, {_defined('contribution_before_campaign')}
  FROM campaign_days GROUP BY promotion_id),
s AS (
  SELECT a.promotion_id, r.rep, sum(v.contribution_before_campaign) - m.campaign_cost AS sample
  FROM a JOIN m01_controls m USING (promotion_id), range(1000) r(rep), range(14) j(j)
  JOIN campaign_days v ON v.promotion_id = a.promotion_id
   AND v.campaign_day = ('0x' || substr(md5(concat_ws('|', a.promotion_id, r.rep, j.j, 42)), 1, 8))::BIGINT
                        % a.aligned_days
  WHERE a.contribution_before_campaign IS NOT NULL AND j.j < a.aligned_days
  GROUP BY a.promotion_id, r.rep, m.campaign_cost),
q AS (SELECT promotion_id, quantile_cont(sample, 0.025) AS lo, quantile_cont(sample, 0.975) AS hi
      FROM s GROUP BY promotion_id)
SELECT m.promotion_id, m.restaurant_id, m.campaign_name, m.discount_rate, m.start_date, m.end_date,
       m.control_stores, m.control_restaurant_ids, m.comparison_start,
       a.baseline_revenue, a.observed_revenue, a.incremental_revenue, a.baseline_orders, a.observed_orders,
       a.observed_orders - a.baseline_orders AS incremental_orders, m.campaign_cost,
       a.contribution_before_campaign - m.campaign_cost AS incremental_contribution,
       a.baseline_variable_cost, a.observed_variable_cost,
       a.observed_variable_cost - a.baseline_variable_cost AS incremental_variable_cost,
       a.incremental_labour_cost, a.contribution_before_campaign,
       (a.contribution_before_campaign - m.campaign_cost) / nullif(m.campaign_cost, 0) AS promotion_roi,
       q.lo AS contribution_low95, q.hi AS contribution_high95,
       CASE WHEN m.control_stores = 0 THEN 'No eligible control stores'
            WHEN m.end_date - m.start_date + 1 <> 14
              THEN 'Undefined: campaign length differs from comparison window'
            WHEN a.baseline_revenue IS NULL OR a.aligned_days <> m.end_date - m.start_date + 1
              THEN 'Undefined: zero control mean before'
            ELSE 'Exploratory matched estimate' END AS estimate_status
FROM m01_controls m LEFT JOIN a USING (promotion_id) LEFT JOIN q USING (promotion_id)""",
)

EFFECT_SPEC = (
    "promotion_id:s, restaurant_id:i, campaign_name:s, discount_rate:d, start_date:t, end_date:t, control_stores:i, "
    "control_restaurant_ids:s, comparison_start:t, baseline_revenue:d, observed_revenue:d, incremental_revenue:d, "
    "baseline_orders:d, observed_orders:i, incremental_orders:d, campaign_cost:d, incremental_contribution:d, "
    "baseline_variable_cost:d, observed_variable_cost:d, incremental_variable_cost:d, incremental_labour_cost:d, "
    "contribution_before_campaign:d, promotion_roi:d, contribution_low95:d, contribution_high95:d, estimate_status:s"
)


def _days(ctx):
    """Per campaign-day table, written once under the checkpoint folder (it feeds
    both the estimates and the bootstrap)."""
    return ctx.stored(
        "campaign_days", lambda: promotions.counterfactual_days(ctx.promotions, ctx.restaurants, ctx.store_day)
    )


def _effects(ctx):
    return promotions.promotion_effectiveness(ctx.promotions, ctx.restaurants, ctx.store_day, days=_days(ctx))


@query(
    "m03_promotion_effectiveness",
    typed(with_ctes(["promotion_effectiveness"], "SELECT * FROM promotion_effectiveness"), EFFECT_SPEC),
)
def m03_promotion_effectiveness(ctx):
    """Campaign estimates: counterfactual, contribution, ROI, hash-bootstrap 95 % range."""
    return _effects(ctx)


@query(
    "a30_promotion_summary",
    typed(
        with_ctes(
            ["promotion_effectiveness"],
            """SELECT campaign_name, sum(incremental_contribution) AS incremental_contribution,
       sum(campaign_cost) AS campaign_cost, sum(incremental_revenue) AS incremental_revenue, count(*) AS campaigns,
       sum(incremental_contribution) / nullif(sum(campaign_cost), 0) AS promotion_roi
FROM promotion_effectiveness WHERE incremental_contribution IS NOT NULL GROUP BY campaign_name""",
        ),
        "campaign_name:s, incremental_contribution:d, campaign_cost:d, incremental_revenue:d, campaigns:i, "
        "promotion_roi:d",
    ),
)
def a30_promotion_summary(ctx):
    """Per campaign name over estimable campaigns only; spend excluded with them."""
    return promotions.promotion_summary(_effects(ctx))


@query(
    "m06_campaign_economics",
    typed(
        with_ctes(
            ["promotion_effectiveness"],
            """SELECT promotion_id, measure, amount FROM promotion_effectiveness
UNPIVOT INCLUDE NULLS (amount FOR measure IN (
  baseline_revenue AS 'Estimated no-campaign sales', observed_revenue AS 'Observed net sales',
  incremental_revenue AS 'Estimated incremental sales', campaign_cost AS 'Campaign spend',
  incremental_contribution AS 'Net incremental contribution'))""",
        ),
        "promotion_id:s, measure:s, amount:d",
    ),
)
def m06_campaign_economics(ctx):
    """Five campaign measures in long form."""
    return promotions.campaign_economics(_effects(ctx))
