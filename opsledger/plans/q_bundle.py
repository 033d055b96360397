"""Bundle queries: previews, trailing-window slices, source manifest and the
mart bundle audit (S08, S09, S10, Q17)."""

from __future__ import annotations

from ..operators import bundle, kpi, marts, planning
from ..sources.tables import DRIVER_TABLES
from .oracle_base import cte, typed, with_ctes
from .q_marts import KPI_SQL
from .q_promotions import _effects
from .registry import query

cte("kpis", ["store_day_ledger", "targets", "restaurants"], KPI_SQL)


@query(
    "s08_quarantine_preview",
    typed(
        with_ctes(
            ["quarantined"],
            "SELECT transaction_line_id, order_id, restaurant_id, net_revenue, quality_reason FROM quarantined "
            "ORDER BY transaction_line_id LIMIT 100",
        ),
        "transaction_line_id:i, order_id:i, restaurant_id:i, net_revenue:d, quality_reason:s",
    ),
)
def s08_quarantine_preview(ctx):
    """First 100 quarantined lines in line-id order (S08; the top-k is the feature)."""
    from .q_quality import _split

    _, rejected = _split(ctx)
    cols = ["transaction_line_id", "order_id", "restaurant_id", "net_revenue", "quality_reason"]
    return bundle.preview(rejected.select(*cols), ["transaction_line_id"])


@query(
    "s09_recent_store_day",
    typed(
        with_ctes(
            ["store_day_ledger"],
            "SELECT restaurant_id, business_date, month, revenue, transactions, operating_profit FROM store_day_ledger "
            "WHERE business_date >= (SELECT max(business_date) FROM store_day_ledger) - 91",
        ),
        "restaurant_id:i, business_date:t, month:s, revenue:d, transactions:i, operating_profit:d",
    ),
)
def s09_recent_store_day(ctx):
    """Trailing 92 trading days of the daily ledger."""
    cols = ["restaurant_id", "business_date", "month", "revenue", "transactions", "operating_profit"]
    return bundle.trailing_days(ctx.store_day.select(*cols))


@query(
    "s09_recent_month_kpis",
    typed(
        with_ctes(
            ["kpis"],
            "SELECT restaurant_id, month, revenue, operating_profit, performance_index FROM kpis WHERE month >= "
            "(SELECT strftime(max(business_date) - 91, '%Y-%m') FROM store_day_ledger)",
        ),
        "restaurant_id:i, month:s, revenue:d, operating_profit:d, performance_index:d",
    ),
)
def s09_recent_month_kpis(ctx):
    """Monthly KPIs of the months touched by the trailing 92 days."""
    cols = ["restaurant_id", "month", "revenue", "operating_profit", "performance_index"]
    return bundle.trailing_months(ctx.store_month_kpis.select(*cols), ctx.store_day)


@query("s10_source_manifest")
def s10_source_manifest(ctx):
    """(table, file, bytes, sha256) of every input file."""
    return bundle.source_manifest(ctx.spark, ctx.folder, list(DRIVER_TABLES))


# ---------------------------------------------------------------- Q17
# mart name -> oracle CTE with the same rows
_ORACLE_MARTS = {
    "store_dimension": "restaurants",
    "store_month_kpis": "kpis",
    "store_day": "store_day_ledger",
    "store_hour": "store_hour",
    "product_month": "product_month_o",
    "promotion_effectiveness": "promotion_effectiveness",
    "forecast_daily": "forecast_daily",
    "forecast_backtests": "traces",
    "labour_plan": "hourly_plan",
    "weekly_performance": "weekly_card",
}
cte(
    "product_month_o",
    ["transactions"],
    "SELECT restaurant_id, month, product_id, channel, sum(net_revenue) AS revenue FROM transactions GROUP BY ALL",
)


_WHOLE = {"transactions", "identified_orders", "survey_responses", "deliveries", "late_deliveries"}


def _q17_sql() -> str:
    """Every check as a query that finds its breaches; none found passes."""
    breaches = {}
    for name, src in _ORACLE_MARTS.items():
        keys = bundle.KEYS[name]
        some_null = " OR ".join(f"{k} IS NULL" for k in keys)
        breaches[f"{name}: key"] = f"SELECT 1 FROM {src} GROUP BY {', '.join(keys)} HAVING count(*) > 1 OR bool_or({some_null})"
        breaches[f"{name}: site"] = f"SELECT 1 FROM {src} WHERE restaurant_id IS NULL OR restaurant_id NOT IN (SELECT restaurant_id FROM restaurants)"
    for f in kpi.ADDITIVE:
        gap = f"abs(coalesce(sum(v), 0)) > {0 if f in _WHOLE else 0.010000001}"
        breaches[f"store_month_kpis: {f} equals the days"] = (
            f"SELECT 1 FROM (SELECT restaurant_id, month, {f} AS v, 1 AS side FROM kpis UNION ALL "
            f"SELECT restaurant_id, month, -{f}, 2 FROM store_day_ledger) GROUP BY restaurant_id, month "
            f"HAVING {gap} OR count(DISTINCT side) < 2"
        )
    for name, src, f in (("product_month", "product_month_o", "revenue"), ("store_hour", "store_hour", "revenue"),
                         ("store_hour", "store_hour", "paid_hours")):
        breaches[f"{name}: {f} equals the days"] = (
            f"SELECT 1 WHERE abs((SELECT sum({f}) FROM {src}) - (SELECT sum({f}) FROM store_day_ledger)) > 0.010000001"
        )
    breaches["forecast_backtests: days follow the origin"] = "SELECT 1 FROM traces WHERE business_date <= origin_date"
    breaches["forecast_backtests: holdout comes last"] = (
        "SELECT 1 WHERE NOT coalesce((SELECT max(business_date) FROM traces WHERE evaluation_period = 'Validation') < "
        "(SELECT min(business_date) FROM traces WHERE evaluation_period = 'Holdout'), false)"
    )
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS check_name, CASE WHEN EXISTS ({sql}) THEN 'FAIL' ELSE 'PASS' END AS status"
        for name, sql in breaches.items()
    )


@query(
    "q17_bundle_checks",
    typed(with_ctes(list(_ORACLE_MARTS.values()) + ["restaurants"], _q17_sql()), "check_name:s, status:s"),
)
def q17_bundle_checks(ctx):
    """Mart bundle audit: keys, relationships, monthly/daily/hourly reconciliation, backtest ordering (Q17)."""
    from . import q_decisions

    m = {
        "store_dimension": ctx.restaurants,
        "store_month_kpis": ctx.store_month_kpis,
        "store_day": ctx.store_day,
        "store_hour": ctx.store_hour,
        "product_month": marts.product_month(ctx.transactions, ctx.products),
        "promotion_effectiveness": _effects(ctx),
        "forecast_daily": ctx.forecast_daily,
        "forecast_backtests": ctx.forecast_traces,
        "labour_plan": planning.hourly_plan(ctx.store_day, ctx.planning_hour, ctx.forecast_daily),
        "weekly_performance": q_decisions._card(ctx),
    }
    return bundle.bundle_checks(m, ctx.restaurants)
