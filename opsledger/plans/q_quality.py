"""Data-quality queries over the raw exports: duplicates, keys, line rules,
complete-order quarantine, cascades, repairs, contracts and reconciliations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import marts, quality
from .oracle_base import cte, msum, typed, with_ctes
from .q_sql import monthly_from_facts
from .registry import query

RULE_NAMES = [
    "Missing order identifier",
    "Invalid product foreign key",
    "Invalid timestamp",
    "Outside trading hours",
    "Invalid quantity",
    "Invalid monetary values",
    "Invalid channel category",
    "Revenue reconciliation",
    "GST reconciliation",
]

def _flag(ctx):
    return ctx.flagged, ctx.rule_names


def _split(ctx):
    return quality.quarantine_orders(ctx.flagged)


_DUP_SQL = "\nUNION ALL\n".join(
    f"SELECT '{n}' AS tbl, rows, distinct_rows, rows - distinct_rows AS duplicates_removed FROM "
    f"(SELECT (SELECT count(*) FROM {t}) AS rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM {t})) AS distinct_rows)"
    for n, t in (("transactions", "raw_transactions"), ("labour", "raw_labour"),
                 ("customer_feedback", "raw_customer_feedback"), ("waste", "raw_waste"))
)


@query(
    "q01_duplicate_audit",
    typed(
        with_ctes(["raw_transactions", "raw_labour", "raw_customer_feedback", "raw_waste"], _DUP_SQL),
        "tbl:s, rows:i, distinct_rows:i, duplicates_removed:i",
    ),
)
def q01_duplicate_audit(ctx):
    """Exact duplicate rows per raw export."""
    return quality.duplicate_audit(
        {
            "transactions": ctx.raw_transactions,
            "labour": ctx.raw_labour,
            "customer_feedback": ctx.raw_customer_feedback,
            "waste": ctx.raw_waste,
        },
        {name: keys for name, (_, keys) in TABLES.items()},
    ).withColumnRenamed("table", "tbl")


_KEYS = {
    "transactions": ("raw_transactions", ["transaction_line_id"]),
    "labour": ("raw_labour", ["shift_id"]),
    "customer_feedback": ("raw_customer_feedback", ["feedback_id"]),
    "waste": ("raw_waste", ["waste_id"]),
    "loyalty": ("raw_loyalty", ["loyalty_event_id"]),
    "delivery": ("raw_delivery", ["order_id"]),
    "targets": ("targets", ["restaurant_id", "month"]),
    "calendar": ("calendar", ["business_date", "state"]),
    "transactions_by_line": ("raw_transactions", ["order_id", "product_id"]),
}


def _kc_sql() -> str:
    parts = []
    for name, (src, keys) in _KEYS.items():
        k = ", ".join(keys)
        nul = " OR ".join(f"{x} IS NULL" for x in keys)
        parts.append(
            f"""SELECT '{name}' AS tbl, coalesce(sum(n - 1), 0) AS duplicate_key_rows,
       coalesce(sum(CASE WHEN has_null THEN n END), 0) AS null_key_rows
FROM (SELECT {k}, count(*) AS n, bool_or({nul}) AS has_null FROM (SELECT DISTINCT * FROM {src}) GROUP BY {k})"""
        )
    return "\nUNION ALL\n".join(parts)


@query(
    "q02_key_conflicts",
    typed(
        with_ctes([v[0] for v in _KEYS.values()], _kc_sql()),
        "tbl:s, duplicate_key_rows:i, null_key_rows:i",
    ),
)
def q02_key_conflicts(ctx):
    """Conflicting and null primary keys after exact dedup (Q02)."""
    out = None
    for name, (src, keys) in _KEYS.items():
        df = quality.without_repeats(getattr(ctx, src), keys)
        part = quality.key_conflicts(df, name, keys).withColumnRenamed("table", "tbl")
        out = part if out is None else out.unionByName(part)
    return out


_RULE_SQL = "\nUNION ALL\n".join(
    f"SELECT 'transactions' AS tbl, '{n}' AS rule, count(*) FILTER (WHERE r{i}) AS affected_rows FROM flagged"
    for i, n in enumerate(RULE_NAMES)
)


@query("q05_rule_audit", typed(with_ctes(["flagged"], _RULE_SQL), "tbl:s, rule:s, affected_rows:i"))
def q05_rule_audit(ctx):
    """Per-rule affected rows of the nine line rules."""
    flagged, names = _flag(ctx)
    return quality.rule_audit(flagged, names).select(
        F.col("table").alias("tbl"), "rule", "affected_rows"
    )


@query(
    "q06_quarantine_lines",
    typed(
        with_ctes(
            ["quarantined"],
            "SELECT transaction_line_id, order_id, restaurant_id, net_revenue, quality_reason FROM quarantined",
        ),
        "transaction_line_id:i, order_id:i, restaurant_id:i, net_revenue:d, quality_reason:s",
    ),
)
def q06_quarantine_lines(ctx):
    """Complete-order quarantine with reasons, companions included."""
    _, rejected = _split(ctx)
    return rejected.select("transaction_line_id", "order_id", "restaurant_id", "net_revenue", "quality_reason")


@query(
    "a41_quality_summary",
    typed(
        with_ctes(
            ["flagged", "clean_lines", "quarantined"],
            f"""SELECT (SELECT count(*) FROM flagged) AS raw_lines_after_dedup,
       (SELECT count(*) FROM clean_lines) AS clean_lines,
       (SELECT count(DISTINCT order_id) FROM clean_lines) AS clean_orders,
       (SELECT count(DISTINCT order_id) FROM flagged WHERE invalid) AS quarantined_orders,
       (SELECT {msum('net_revenue')} FROM clean_lines) AS clean_revenue,
       (SELECT {msum('net_revenue')} FROM quarantined) AS quarantined_revenue""",
        ),
        "raw_lines_after_dedup:i, clean_lines:i, clean_orders:i, quarantined_orders:i, clean_revenue:d, "
        "quarantined_revenue:d",
    ),
)
def a41_quality_summary(ctx):
    """Clean vs quarantined lines, orders and revenue, in one grouping by order."""
    return quality.quality_summary(ctx.flagged)


@query(
    "q07_event_cascade",
    typed(
        with_ctes(
            ["clean_lines", "raw_delivery", "raw_loyalty"],
            """SELECT 'delivery' AS tbl,
       count(*) FILTER (WHERE order_id IS NOT NULL AND order_id NOT IN (SELECT order_id FROM clean_lines)) AS lost_rows,
       count(*) FILTER (WHERE order_id IS NULL OR order_id IN (SELECT order_id FROM clean_lines)) AS kept_rows
FROM raw_delivery
UNION ALL
SELECT 'loyalty',
       count(*) FILTER (WHERE order_id IS NOT NULL AND order_id NOT IN (SELECT order_id FROM clean_lines)),
       count(*) FILTER (WHERE order_id IS NULL OR order_id IN (SELECT order_id FROM clean_lines))
FROM raw_loyalty""",
        ),
        "tbl:s, lost_rows:i, kept_rows:i",
    ),
)
def q07_event_cascade(ctx):
    """Delivery and loyalty events of quarantined orders are excluded (Q07)."""
    clean, _ = _split(ctx)
    out = None
    for name, df in (("delivery", ctx.raw_delivery), ("loyalty", ctx.raw_loyalty)):
        kept, lost = quality.cascade_lost_orders(df, clean)
        part = lost.agg(F.count(F.lit(1)).alias("lost_rows")).select(
            F.lit(name).alias("tbl"), "lost_rows", kept.select(F.count(F.lit(1))).scalar().alias("kept_rows")
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "q08_survey_repair",
    typed(
        with_ctes(
            ["raw_customer_feedback", "clean_lines"],
            """WITH ok AS (SELECT DISTINCT order_id AS ok_id FROM clean_lines)
SELECT feedback_id,
       CASE WHEN f.order_id IS NOT NULL AND ok.ok_id IS NULL THEN NULL ELSE f.order_id END AS order_id,
       restaurant_id, business_date,
       CASE WHEN overall_score IS NOT NULL AND NOT overall_score BETWEEN 1 AND 5 THEN NULL ELSE overall_score END AS overall_score,
       food_score, service_score,
       (overall_score IS NOT NULL AND NOT overall_score BETWEEN 1 AND 5) AS score_repaired,
       (f.order_id IS NOT NULL AND ok.ok_id IS NULL) AS order_link_removed
FROM raw_customer_feedback f LEFT JOIN ok ON f.order_id = ok.ok_id""",
        ),
        "feedback_id:i, order_id:i, restaurant_id:i, business_date:t, overall_score:d, food_score:d, "
        "service_score:d, score_repaired:b, order_link_removed:b",
    ),
)
def q08_survey_repair(ctx):
    """Survey repair: bad scores nulled, lost order links nulled, rows kept (Q08)."""
    clean, _ = _split(ctx)
    return quality.repair_surveys(ctx.raw_customer_feedback, clean)


LABOUR_SPEC = (
    "shift_id:i, restaurant_id:i, employee_id:s, role:s, business_date:t, daypart:s, scheduled_start:x, "
    "scheduled_end:x, actual_start:x, actual_end:x, break_hours:d, paid_hours:d, hourly_cost:d, rate_imputed:i, "
    "labour_cost:d, hours_repaired:b"
)


@query(
    "q10_labour_repair",
    typed(
        with_ctes(
            ["repaired_labour"],
            "SELECT * FROM repaired_labour",
        ),
        LABOUR_SPEC,
    ),
)
def q10_labour_repair(ctx):
    """Paid-hours repair from shift timestamps and median rate imputation."""
    return quality.repair_labour(ctx.raw_labour, ctx.restaurants, ctx.calendar)


@query(
    "q11_waste_quarantine",
    typed(
        with_ctes(["raw_waste"], "SELECT * FROM raw_waste WHERE waste_units < 0 OR waste_cost < 0"),
        "waste_id:i, restaurant_id:i, product_id:i, business_date:t, waste_units:i, waste_cost:d, reason:s",
    ),
)
def q11_waste_quarantine(ctx):
    """Negative waste records are quarantined, not zeroed (Q11)."""
    return quality.split_negative_waste(ctx.raw_waste)[1]


TX_COLUMNS = (
    "transaction_line_id order_id restaurant_id restaurant_name timestamp_local product_id quantity channel "
    "customer_id promotion_id list_revenue discount_amount net_revenue gst_amount ingredient_cost"
).split()
OPTIONAL = {"customer_id", "promotion_id", "order_id"}


def _contract_sql() -> str:
    req = [c for c in TX_COLUMNS if c not in OPTIONAL or c == "order_id"]
    req_null = " OR ".join(f"{c} IS NULL" for c in req)
    money = ["list_revenue", "discount_amount", "net_revenue", "gst_amount", "ingredient_cost"]
    rows = [
        ("Schema columns", "count(*) * 0", "all expected columns are there"),
        ("Unique primary key", "min((SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM d GROUP BY transaction_line_id)))", "transaction_line_id"),
        ("Primary key populated", "count(*) FILTER (WHERE transaction_line_id IS NULL)", "no key part may be null"),
        ("Required values", f"count(*) FILTER (WHERE {req_null})", ", ".join(sorted(req))),
        ("Restaurant relationship", "count(*) FILTER (WHERE s.restaurant_id IS NULL)", "site is in the site master"),
        ("Valid timestamp_local", "count(*) FILTER (WHERE try_cast(d.timestamp_local AS TIMESTAMP) IS NULL)", "reads as a date or time"),
    ]
    rows += [
        (f"Valid {m}", f"count(*) FILTER (WHERE {m} IS NULL OR isnan({m}) OR isinf({m}) OR {m} < 0)",
         "finite amount, zero or more")
        for m in money
    ]
    sel = "\nUNION ALL\n".join(
        f"SELECT 'transactions' AS tbl, '{n}' AS rule, {e} AS invalid_rows, '{det}' AS detail "
        f"FROM d LEFT JOIN (SELECT DISTINCT restaurant_id FROM restaurants) s USING (restaurant_id)"
        for n, e, det in rows
    )
    return f"""WITH d AS (SELECT DISTINCT * FROM raw_transactions)
SELECT tbl, rule, invalid_rows, CASE WHEN invalid_rows > 0 THEN 'FAIL' ELSE 'PASS' END AS status, detail
FROM ({sel})"""


@query(
    "q12_contract_checks",
    typed(
        with_ctes(["raw_transactions", "restaurants"], _contract_sql()),
        "tbl:s, rule:s, invalid_rows:i, status:s, detail:s",
    ),
)
def q12_contract_checks(ctx):
    """Contract checks on the deduplicated raw lines (Q12, Q03)."""
    req = [c for c in TX_COLUMNS if c not in OPTIONAL or c == "order_id"]
    out = quality.contract_checks(
        quality.without_repeats(ctx.raw_transactions, ["transaction_line_id"]),
        "transactions",
        ["transaction_line_id"],
        req,
        TX_COLUMNS,
        store_ids=ctx.restaurants,
        date_fields=["timestamp_local"],
        money_fields=["list_revenue", "discount_amount", "net_revenue", "gst_amount", "ingredient_cost"],
    )
    return out.withColumnRenamed("table", "tbl")


def _missing_sql() -> str:
    parts = [
        f"SELECT 'transactions' AS tbl, '{c}' AS col, count(*) FILTER (WHERE {c} IS NULL) AS missing_rows, "
        f"count(*) AS total_rows, {'false' if c in OPTIONAL - {'order_id'} else 'true'} AS required FROM raw_transactions"
        for c in TX_COLUMNS
    ]
    return "\nUNION ALL\n".join(parts)


@query(
    "q13_missing_profile",
    typed(with_ctes(["raw_transactions"], _missing_sql()), "tbl:s, col:s, missing_rows:i, total_rows:i, required:b"),
)
def q13_missing_profile(ctx):
    """Missing values per column of the raw lines (Q13)."""
    req = [c for c in TX_COLUMNS if c not in OPTIONAL or c == "order_id"]
    return quality.missing_profile(ctx.raw_transactions.select(*TX_COLUMNS), "transactions", req).select(
        F.col("table").alias("tbl"), F.col("column").alias("col"), "missing_rows", "total_rows", "required"
    )


#: Each table the context builds: its attribute and primary key.
TABLES = {
    "restaurants": ("restaurants", ["restaurant_id"]),
    "products": ("products", ["product_id"]),
    "transactions": ("raw_transactions", ["transaction_line_id"]),
    "labour": ("raw_labour", ["shift_id"]),
    "customer_feedback": ("raw_customer_feedback", ["feedback_id"]),
    "loyalty": ("raw_loyalty", ["loyalty_event_id"]),
    "promotions": ("promotions", ["promotion_id"]),
    "waste": ("raw_waste", ["waste_id"]),
    "targets": ("targets", ["restaurant_id", "month"]),
    "operating_costs": ("operating_costs", ["cost_id"]),
    "delivery": ("raw_delivery", ["order_id"]),
    "calendar": ("calendar", ["business_date", "state"]),
}
NULLABLE = OPTIONAL | {"holiday_name", "overall_score", "food_score", "service_score"}
DATES = (
    "business_date event_date start_date end_date timestamp_local actual_start actual_end scheduled_start scheduled_end"
).split()
MONEY = (
    "list_revenue discount_amount net_revenue gst_amount ingredient_cost "
    "hourly_cost labour_cost waste_cost campaign_cost amount revenue_target"
).split()


def _tables(ctx):
    """(name, rows, keys, required columns) of every table."""
    for name, (source, keys) in TABLES.items():
        df = getattr(ctx, source)
        if name == "transactions":
            df = df.select(*TX_COLUMNS)
            keys_and = {*keys, "order_id"}
        else:
            keys_and = set(keys)
        yield name, df, keys, [c for c in df.columns if c not in NULLABLE or c in keys_and]


#: Rules beyond keys, types and amounts: the operator's conditions, and the same in SQL.
_RULES = {"transactions": quality.line_contract_rules, "products": quality.product_contract_rules}
_TAXONOMY = sorted(set(quality.CATEGORY_ALIASES.values()))
_RULE_SQL = {
    "transactions": [
        ("Net revenue reconciles", "abs(list_revenue - discount_amount - net_revenue) <= 0.011", "list less discount is net"),
        ("GST reconciles", "abs(net_revenue * 0.1 - gst_amount) <= 0.011", "a tenth of net"),
        ("Known channel", "channel IN ('Dine-in', 'Takeaway', 'Delivery')", "Dine-in, Takeaway, Delivery"),
    ],
    "products": [("Approved category", f"category IN ({', '.join(map(repr, _TAXONOMY))})", ", ".join(_TAXONOMY))],
}
#: Columns of every table with their SQL types; the raw products have categories as exported.
_SQL_COLUMNS = {
    "restaurants": "restaurant_id restaurant_name state location_type area seats open_hour close_hour",
    "products": "product_id product_name category menu_price_ex_gst standard_ingredient_cost",
    "transactions": " ".join(TX_COLUMNS),
    "labour": "shift_id restaurant_id employee_id role business_date daypart scheduled_start scheduled_end actual_start actual_end break_hours paid_hours hourly_cost",
    "customer_feedback": "feedback_id order_id restaurant_id business_date overall_score food_score service_score",
    "loyalty": "loyalty_event_id customer_id restaurant_id order_id event_date event_type points",
    "promotions": "promotion_id restaurant_id campaign_name start_date end_date discount_rate eligible_category campaign_cost",
    "waste": "waste_id restaurant_id product_id business_date waste_units waste_cost reason",
    "targets": "restaurant_id month revenue_target operating_margin_target labour_pct_target waste_pct_target satisfaction_target",
    "operating_costs": "cost_id restaurant_id month cost_category amount",
    "delivery": "order_id restaurant_id promised_minutes actual_minutes commission_cost delivery_fee status",
    "calendar": "business_date state holiday_name is_public_holiday weekday is_weekend month season school_holiday_proxy",
}


#: Oracle table of each table, where it is not the source's name.
_ORACLE_SOURCE = {"restaurants": "site_master"}
cte("site_master", ["restaurants"], "SELECT *, 40 + (restaurant_id % 5) * 10 AS seats, 11 AS open_hour, 22 AS close_hour FROM restaurants")


def _required(name: str, columns: list[str]) -> list[str]:
    keys = {*TABLES[name][1]} | ({"order_id"} if name == "transactions" else set())
    return [c for c in columns if c not in NULLABLE or c in keys]


def _table_contract_sql() -> str:
    parts = []
    for name, (source, keys) in TABLES.items():
        columns = _SQL_COLUMNS[name].split()
        required = _required(name, columns)
        bad = {
            "Primary key populated": (" OR ".join(f"{k} IS NULL" for k in keys), "no key part may be null"),
            "Required values": (" OR ".join(f"{c} IS NULL" for c in required), ", ".join(sorted(required))),
        }
        if "restaurant_id" in columns:
            bad["Restaurant relationship"] = ("restaurant_id IS NULL OR restaurant_id NOT IN (SELECT restaurant_id FROM restaurants)", "site is in the site master")
        bad |= {f"Valid {c}": (f"try_cast({c} AS TIMESTAMP) IS NULL", "reads as a date or time") for c in DATES if c in columns}
        bad |= {f"Valid {c}": (f"{c} IS NULL OR isnan({c}) OR isinf({c}) OR {c} < 0", "finite amount, zero or more") for c in MONEY if c in columns}
        bad |= {rule: (f"NOT coalesce({holds}, false)", detail) for rule, holds, detail in _RULE_SQL.get(name, [])}
        source = _ORACLE_SOURCE.get(name, source)
        d = f"(SELECT DISTINCT {', '.join(columns)} FROM {source})"
        parts.append(f"SELECT '{name}' AS tbl, 'Schema columns' AS rule, 0 AS invalid_rows, 'all expected columns are there' AS detail")
        parts.append(f"SELECT '{name}', 'Unique primary key', (SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM {d} GROUP BY {', '.join(keys)})), '{', '.join(keys)}'")
        parts += [f"SELECT '{name}', '{rule}', (SELECT count(*) FROM {d} WHERE {cond}), '{detail}'" for rule, (cond, detail) in bad.items()]
    return "SELECT tbl, rule, invalid_rows, CASE WHEN invalid_rows > 0 THEN 'FAIL' ELSE 'PASS' END AS status, detail FROM (" + "\nUNION ALL\n".join(parts) + ")"


_SOURCES = sorted({source for source, _ in TABLES.values()} | {"restaurants", *_ORACLE_SOURCE.values()})


@query(
    "q12_table_contracts",
    typed(with_ctes(_SOURCES, _table_contract_sql()), "tbl:s, rule:s, invalid_rows:i, status:s, detail:s"),
)
def q12_table_contracts(ctx):
    """Contract checks on every table, exact repeats removed, with the amount, channel and taxonomy rules (Q12, Q03)."""
    out = [
        quality.contract_checks(
            quality.without_repeats(df, keys), name, keys, required, df.columns,
            store_ids=ctx.restaurants, date_fields=DATES, money_fields=MONEY, rules=_RULES[name]() if name in _RULES else None,
        )
        for name, df, keys, required in _tables(ctx)
    ]
    return reduce(lambda a, b: a.unionByName(b), out).withColumnRenamed("table", "tbl")


def _profile_sql() -> str:
    parts = []
    for name, (source, _) in TABLES.items():
        source, columns = _ORACLE_SOURCE.get(name, source), _SQL_COLUMNS[name].split()
        required = _required(name, columns)
        parts += [
            f"SELECT '{name}' AS tbl, '{c}' AS col, (SELECT count(*) FROM {source} WHERE {c} IS NULL) AS missing_rows, "
            f"(SELECT count(*) FROM {source}) AS total_rows, {str(c in required).lower()} AS required"
            for c in columns
        ]
    return "\nUNION ALL\n".join(parts)


@query(
    "q13_table_profiles",
    typed(with_ctes(_SOURCES, _profile_sql()), "tbl:s, col:s, missing_rows:i, total_rows:i, required:b"),
)
def q13_table_profiles(ctx):
    """Missing values per column of every table (Q13)."""
    out = [quality.missing_profile(df, name, required) for name, df, _, required in _tables(ctx)]
    return reduce(lambda a, b: a.unionByName(b), out).withColumnsRenamed({"table": "tbl", "column": "col"})


#: Cleaned tables whose rows the quality summary counts: context attribute and oracle table.
_CLEAN = ("transactions", "labour", "customer_feedback", "loyalty", "waste", "delivery")


@query(
    "a41_table_rows",
    typed(
        with_ctes([*_CLEAN], " UNION ALL ".join(f"SELECT '{t}' AS tbl, (SELECT count(*) FROM {t}) AS rows" for t in _CLEAN)),
        "tbl:s, rows:i",
    ),
)
def a41_table_rows(ctx):
    """Rows of every cleaned table."""
    return quality.rows_per_table({t: getattr(ctx, t) for t in _CLEAN})


@query(
    "a39_imputed_shifts",
    typed(
        with_ctes(
            ["repaired_labour"],
            """SELECT role, count(*) AS shifts, count(*) FILTER (WHERE hours_repaired) AS repaired_hours, sum(rate_imputed) AS imputed_rates,
       sum(rate_imputed) / count(*) AS imputed_share, avg(CASE WHEN rate_imputed = 1 THEN hourly_cost END) AS mean_imputed_rate
FROM repaired_labour GROUP BY role""",
        ),
        "role:s, shifts:i, repaired_hours:i, imputed_rates:i, imputed_share:d, mean_imputed_rate:d",
    ),
)
def a39_imputed_shifts(ctx):
    """Repaired hours and imputed rates per role."""
    return quality.imputed_shift_summary(quality.repair_labour(ctx.raw_labour, ctx.restaurants, ctx.calendar))


@query(
    "q14_revenue_reconciliation",
    typed(
        with_ctes(
            ["transactions", "store_month_kpis"],
            f"""WITH cells AS (
  SELECT restaurant_id, month, {msum('net_revenue')} AS sold, NULL::DOUBLE AS reported, 1 AS l, 0 AS r
  FROM transactions GROUP BY restaurant_id, month
  UNION ALL SELECT restaurant_id, month, NULL, revenue, 0, 1 FROM store_month_kpis),
s AS (SELECT restaurant_id, month, max(sold) AS left_value, max(reported) AS right_value, sum(l) AS l, sum(r) AS r
      FROM cells GROUP BY restaurant_id, month)
SELECT restaurant_id, month, left_value, right_value,
       CASE l - r WHEN 0 THEN 'both' WHEN 1 THEN 'left_only' ELSE 'right_only' END AS match,
       l <> r OR abs(left_value - right_value) > 0.010000001 AS mismatch
FROM s""",
        ),
        "restaurant_id:i, month:s, left_value:d, right_value:d, match:s, mismatch:b",
    ),
)
def q14_revenue_reconciliation(ctx):
    """Monthly revenue from source facts against the KPI mart, full outer join."""
    return quality.reconcile(monthly_from_facts(ctx), ctx.store_month_kpis, ["restaurant_id", "month"], "revenue")


@query(
    "q15_ledger_identity",
    typed(
        with_ctes(
            ["store_day_ledger"],
            """SELECT count(*) AS checked_days,
       count(*) FILTER (WHERE abs(revenue - (ingredient_cost + waste_cost + labour_cost + commission_cost
                        + coalesce(overhead_cost, 0) + campaign_cost) - operating_profit) > 0.01) AS broken_days
FROM store_day_ledger""",
        ),
        "checked_days:i, broken_days:i",
    ),
)
def q15_ledger_identity(ctx):
    """Revenue less six costs equals operating profit on every day (Q15)."""
    d = ctx.store_day
    return d.agg(F.count(F.lit(1)).alias("checked_days")).select(
        "checked_days", quality.ledger_breaks(d, marts.COSTS).select(F.count(F.lit(1))).scalar().alias("broken_days")
    )


@query(
    "q16_order_consistency",
    typed(
        with_ctes(
            ["raw_transactions"],
            """SELECT order_id, count(DISTINCT restaurant_id) AS stores, count(DISTINCT timestamp_local) AS timestamps,
       count(DISTINCT channel) AS channels
FROM raw_transactions GROUP BY order_id
HAVING count(DISTINCT restaurant_id) > 1 OR count(DISTINCT timestamp_local) > 1 OR count(DISTINCT channel) > 1""",
        ),
        "order_id:i, stores:i, timestamps:i, channels:i",
    ),
)
def q16_order_consistency(ctx):
    """Orders with more than one store, timestamp or channel in the raw export (Q16)."""
    return quality.order_inconsistencies(ctx.raw_transactions)


@query(
    "q18_coverage_gaps",
    typed(
        with_ctes(
            ["restaurants", "calendar", "orders_mart"],
            """SELECT r.restaurant_id, c.business_date FROM restaurants r JOIN calendar c ON r.state = c.state
WHERE NOT EXISTS (SELECT 1 FROM orders_mart o WHERE o.restaurant_id = r.restaurant_id
                  AND o.business_date = c.business_date)""",
        ),
        "restaurant_id:i, business_date:t",
    ),
)
def q18_coverage_gaps(ctx):
    """Site-days of the calendar spine with no clean order."""
    spine = marts.spine(ctx.restaurants, ctx.calendar)
    return quality.coverage_gaps(spine, ctx.orders, ["restaurant_id", "business_date"])


@query(
    "p06_name_repairs",
    typed(
        with_ctes(
            ["raw_transactions", "restaurants"],
            """SELECT count(*) FILTER (WHERE t.restaurant_name IS DISTINCT FROM r.restaurant_name) AS changed_rows
FROM raw_transactions t LEFT JOIN restaurants r USING (restaurant_id)""",
        ),
        "changed_rows:i",
    ),
)
def p06_name_repairs(ctx):
    """Store names replaced from the master by id; count of changed lines."""
    return quality.name_mismatches(ctx.raw_transactions, ctx.restaurants)


# ---------------------------------------------------------------- P04 / P05
cte(
    "raw_products",
    ["products"],
    """SELECT product_id, product_name,
       CASE WHEN product_id % 11 = 0 THEN CASE category WHEN 'ECONOMY' THEN 'LARGE' WHEN 'LARGE' THEN 'MEDIUM'
                 WHEN 'MEDIUM' THEN 'PROMO' WHEN 'PROMO' THEN 'SMALL' WHEN 'SMALL' THEN 'STANDARD'
                 WHEN 'STANDARD' THEN 'ECONOMY' END
            WHEN product_id % 7 = 0 THEN '  ' || lower(category) || ' '
            ELSE category END AS category,
       menu_price_ex_gst, standard_ingredient_cost
FROM products""",
)
_ALIAS_SQL = "CASE lower(trim(category)) " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in quality.CATEGORY_ALIASES.items()
) + " END"


@query(
    "p04_category_aliases",
    typed(
        with_ctes(
            ["raw_products"],
            f"""SELECT product_id, category AS raw_category, {_ALIAS_SQL} AS category,
       category IS DISTINCT FROM {_ALIAS_SQL} AS alias_mapped
FROM raw_products""",
        ),
        "product_id:i, raw_category:s, category:s, alias_mapped:b",
    ),
)
def p04_category_aliases(ctx):
    """Category text normalised by strip + lower + alias map; unknown raises."""
    return quality.normalise_categories(ctx.src.raw_products()).select(
        "product_id", "raw_category", "category", "alias_mapped"
    )


@query(
    "p05_taxonomy_override",
    typed(
        with_ctes(
            ["raw_products", "products"],
            f"""SELECT r.product_id, {_ALIAS_SQL.replace('category', 'r.category')} AS source_category,
       p.category AS category, {_ALIAS_SQL.replace('category', 'r.category')} IS DISTINCT FROM p.category AS corrected
FROM raw_products r LEFT JOIN products p USING (product_id)""",
        ),
        "product_id:i, source_category:s, category:s, corrected:b",
    ),
)
def p05_taxonomy_override(ctx):
    """Approved master taxonomy beats the (alias-normalised) source; corrections flagged."""
    norm = quality.normalise_categories(ctx.src.raw_products())
    return quality.override_taxonomy(norm, ctx.products.select("product_id", "category")).select(
        "product_id", "source_category", "category", "corrected"
    )
