"""Dictionary, grain and lineage of the stored marts."""

from __future__ import annotations

import re

from ..operators import catalog
from . import q_analysis, q_decisions, q_feeds, q_marts, q_planning, q_promotions
from .registry import ORACLE, query

#: Each dataset and the registered query with its rows.
_QUERIES = {
    "store_dimension": (q_feeds, "u02_store_dimension"),
    "orders": (q_marts, "a01_orders"),
    "product_month": (q_marts, "a02_product_month"),
    "waste_detail": (q_marts, "a05_waste_detail"),
    "store_day": (q_marts, "a10_store_day"),
    "store_hour": (q_marts, "a11_store_hour"),
    "store_month_kpis": (q_marts, "a12_store_month_kpis"),
    "customer_segment_summary": (q_analysis, "a37_segment_summary"),
    "customer_cohorts": (q_analysis, "c06_customer_cohorts"),
    "campaign_days": (q_promotions, "m02_counterfactual_days"),
    "promotion_effectiveness": (q_promotions, "m03_promotion_effectiveness"),
    "forecast_backtests": (q_analysis, "f07_naive_backtest"),
    "forecast_daily": (q_planning, "f10_forecast_daily"),
    "labour_plan": (q_planning, "l02_hourly_plan"),
    "weekly_performance": (q_decisions, "x07_weekly_scorecard"),
}


def _stored(ctx):
    """Every dataset as stored with its schema comments, read back from the files."""

    def build(name, module, q):
        return lambda: catalog.described(name, getattr(module, q)(ctx))

    return {name: ctx.stored(f"bundle_{name}", build(name, module, q)) for name, (module, q) in _QUERIES.items()}


def _columns(q: str) -> list[str]:
    """Output columns of a query, from the typed projection of its SQL."""
    head = ORACLE[q][: ORACLE[q].index("FROM (")]
    return re.findall(r" AS ([a-z_0-9]+)(?=,|\s*$)", re.sub(r"CAST\(|AS (DOUBLE|BIGINT|VARCHAR|DATE|BOOLEAN|TIMESTAMP)\)", "", head))


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _dictionary_sql() -> str:
    rows = [
        f"({_text(name)}, {_text(c)}, {_text(catalog.definition(c))}, {str(c in catalog.DATASETS[name].keys).lower()})"
        for name, (_, q) in _QUERIES.items()
        for c in _columns(q)
    ]
    return "SELECT * FROM (VALUES " + ",\n".join(rows) + ") t(tbl, field, definition, is_pk)"


def _catalog_sql() -> str:
    parts = []
    for name, (_, q) in _QUERIES.items():
        about = catalog.DATASETS[name]
        parts.append(
            f"SELECT {_text(name)} AS dataset, {_text(', '.join(about.keys))} AS grain_keys, {_text(about.grain)} AS grain, "
            f"{_text(', '.join(about.lineage))} AS lineage, count(*) AS rows, count(*) - count(DISTINCT ({', '.join(about.keys)})) AS repeated_keys FROM ({ORACLE[q]}) x"
        )
    return "\nUNION ALL\n".join(parts)


@query("s11_schema_dictionary", _dictionary_sql())
def s11_schema_dictionary(ctx):
    """Definition and key mark of every field, read from the stored marts' schemas."""
    return catalog.schema_dictionary(ctx.spark, _stored(ctx))


@query("s12_grain_catalog", _catalog_sql())
def s12_grain_catalog(ctx):
    """Keys, grain, lineage, rows and repeated keys of the 15 stored marts."""
    return catalog.grain_catalog(_stored(ctx))
