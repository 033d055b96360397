"""Action evidence log queries over the append-only status events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import actions, contracts
from ..operators.scenarios import Scenario
from .oracle_base import cte, typed, with_ctes
from .registry import query

cte(
    "action_events",
    [],
    """SELECT user_id AS action_id, event_id, ts AS created_at,
       CASE event_type WHEN 'view' THEN 'proposed' WHEN 'click' THEN 'approved' WHEN 'purchase' THEN 'in progress'
                       WHEN 'signup' THEN 'completed' WHEN 'error' THEN 'cancelled' END AS status,
       props AS note, value
FROM events""",
)
cte(
    "action_audit",
    ["action_events"],
    """WITH e AS (
  SELECT *, row_number() OVER w AS sequence, lag(status) OVER w AS previous_status
  FROM action_events WINDOW w AS (PARTITION BY action_id ORDER BY created_at, event_id)),
v AS (
  SELECT *, CASE
    WHEN status IS NULL OR status NOT IN ('proposed', 'approved', 'in progress', 'completed', 'cancelled')
      THEN 'Unknown status'
    WHEN previous_status IS NULL AND status <> 'proposed' THEN 'Action must start as proposed'
    WHEN previous_status IS NULL THEN NULL
    WHEN previous_status IN ('completed', 'cancelled') THEN 'Terminal action changed'
    WHEN NOT ((previous_status = 'proposed' AND status IN ('approved', 'cancelled'))
           OR (previous_status = 'approved' AND status IN ('in progress', 'cancelled', 'proposed'))
           OR (previous_status = 'in progress' AND status IN ('completed', 'cancelled', 'proposed')))
      THEN 'Invalid status transition' END AS violation
  FROM e)
SELECT action_id, sequence, event_id, created_at, previous_status, status, violation, violation IS NULL AS valid
FROM v""",
)


@query(
    "e03_transition_audit",
    typed(
        with_ctes(["action_audit"], "SELECT * FROM action_audit"),
        "action_id:i, sequence:i, event_id:i, created_at:x, previous_status:s, status:s, violation:s, valid:b",
    ),
)
def e03_transition_audit(ctx):
    """Each status event with its predecessor and violation reason."""
    return actions.transition_audit(ctx.action_events)


@query(
    "e03_violation_summary",
    typed(
        with_ctes(
            ["action_audit"],
            """SELECT action_id, count(*) AS events, count(*) FILTER (WHERE NOT valid) AS violations,
       min(CASE WHEN NOT valid THEN sequence END) AS first_violation_sequence
FROM action_audit GROUP BY action_id""",
        ),
        "action_id:i, events:i, violations:i, first_violation_sequence:i",
    ),
)
def e03_violation_summary(ctx):
    """Per action: events, violations and the first violating position."""
    return actions.violation_summary(actions.transition_audit(ctx.action_events))


@query(
    "e02_current_state",
    typed(
        with_ctes(
            ["action_events"],
            """SELECT action_id, count(*) AS events, min(created_at) AS first_event_at, max(created_at) AS last_event_at,
       arg_max(status, (created_at, event_id)) AS current_status,
       count(*) FILTER (WHERE status = 'proposed') AS proposals,
       arg_max(status, (created_at, event_id)) NOT IN ('completed', 'cancelled') AS is_open
FROM action_events GROUP BY action_id""",
        ),
        "action_id:i, events:i, first_event_at:x, last_event_at:x, current_status:s, proposals:i, is_open:b",
    ),
)
def e02_current_state(ctx):
    """Latest status, event count, first / last event, open flag per action."""
    return actions.current_state(ctx.action_events)


def _fingerprint_sql(source: str) -> str:
    """Fingerprints per action of a CTE or subquery, from the definition."""
    field = lambda x: f"coalesce('=' || hex({x}), '-')"
    text = " || ',' || ".join(
        field(x)
        for x in ("CAST(event_id AS VARCHAR)", "strftime(created_at, '%Y-%m-%d %H:%M:%S.%f')", "status", "note",
                  "CAST(CAST(value AS DECIMAL(38, 12)) AS VARCHAR)")
    )
    sums = " || '-' || ".join(
        f"CAST(sum(CAST(CAST('0x' || substr(d, {1 + 15 * i}, 15) AS BIGINT) AS HUGEINT)) AS VARCHAR)" for i in range(4)
    )
    return f"""SELECT action_id, count(*) AS events, {sums} AS fingerprint
FROM (SELECT action_id, sha256({text}) AS d FROM {source}) GROUP BY action_id"""


@query(
    "e07_action_fingerprints",
    typed(with_ctes(["action_events"], _fingerprint_sql("action_events")), "action_id:i, events:i, fingerprint:s"),
)
def e07_action_fingerprints(ctx):
    """Order-independent event-snapshot fingerprint per action."""
    return actions.fingerprints(ctx.action_events)


# The snapshot to verify: as stored before every 97th event had its value raised by one.
_ALTERED = "(SELECT action_id, event_id, created_at, status, note, value + CASE WHEN event_id % 97 = 0 THEN 1 ELSE 0 END AS value FROM action_events)"


@query(
    "e07_fingerprint_check",
    typed(
        with_ctes(
            ["action_events"],
            f"""SELECT action_id, CASE WHEN a.fingerprint = b.fingerprint THEN 'intact' ELSE 'altered' END AS state
FROM ({_fingerprint_sql('action_events')}) a JOIN ({_fingerprint_sql(_ALTERED)}) b USING (action_id)""",
        ),
        "action_id:i, state:s",
    ),
)
def e07_fingerprint_check(ctx):
    """Which actions' events differ from their stored fingerprints, after planted edits."""
    raised = F.col("value") + F.when(F.col("event_id") % 97 == 0, 1).otherwise(0)
    return actions.verify_fingerprints(actions.fingerprints(ctx.action_events), ctx.action_events.withColumn("value", raised))


# ---------------------------------------------------------------- plans, proposals and outcomes
cte(
    "action_seq",
    ["action_events"],
    """SELECT *, row_number() OVER w AS sequence,
       CAST(sum(CASE WHEN status = 'proposed' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS revision
FROM action_events WINDOW w AS (PARTITION BY action_id ORDER BY created_at, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
cte(
    "proposals",
    ["action_events", "store_month_kpis"],
    """SELECT a.action_id, CASE WHEN a.action_id % 17 = 0 THEN -1 ELSE a.action_id % 25 END AS restaurant_id, k.restaurant_name,
       CASE WHEN a.action_id % 19 = 0 THEN '2025-13' ELSE '2025-12' END AS period,
       revenue, discounts, transactions, ingredient_cost, waste_cost, labour_cost, paid_hours, commission_cost,
       overhead_cost, campaign_cost, operating_profit + CASE WHEN a.action_id % 37 = 0 THEN 1 ELSE 0 END AS operating_profit,
       labour_cost_pct, waste_pct, operating_margin_pct, satisfaction_score,
       revenue > 0 AND transactions > 0 AND paid_hours > 0 AND discounts >= 0 AND waste_cost >= 0 AND labour_cost >= 0
         AND commission_cost >= 0 AND overhead_cost >= 0 AND campaign_cost >= 0 AND ingredient_cost >= 0
         AND (ingredient_cost > 0 OR waste_cost = 0) AS sound
FROM (SELECT DISTINCT action_id FROM action_events) a
LEFT JOIN store_month_kpis k ON k.restaurant_id = a.action_id % 25 AND k.month = '2025-12'""",
)
cte(
    "revisions",
    ["action_seq"],
    """WITH e AS (SELECT *, event_id AS x FROM action_seq WHERE status = 'proposed'),
d AS (SELECT *, CASE WHEN x % 41 = 0 THEN DATE '2025-12-20' ELSE DATE '2026-01-01' + CAST(x % 20 AS INTEGER) END AS start_date FROM e)
SELECT action_id, revision, created_at, x, start_date,
       start_date + CASE WHEN x % 43 = 0 THEN -1 ELSE 30 END AS end_date,
       start_date + CASE WHEN x % 47 = 0 THEN -2 ELSE 3 END AS measurement_start,
       start_date + CASE WHEN x % 47 = 0 THEN 18 ELSE 23 END AS measurement_end,
       CASE WHEN x % 53 = 0 THEN 'footfall' ELSE
         (['labour_cost_pct', 'waste_pct', 'operating_margin_pct', 'satisfaction_score', 'operating_profit', 'revenue'])[x % 6 + 1] END AS primary_metric,
       CASE WHEN x % 59 = 0 THEN -2 ELSE ([0.2, 0.1, 0.3, 4, 1000, 50000])[x % 6 + 1]::DOUBLE END AS target,
       CASE WHEN x % 61 = 0 THEN 7.0 ELSE 3.5 END AS satisfaction_min, 0.2 AS late_delivery_max,
       CASE WHEN x % 67 = 0 THEN ' ' ELSE 'Owner ' || (x % 7) END AS owner, (x % 5) * -0.01 AS hours_change, (x % 3) * 0.01 AS price_change
FROM d""",
)
cte(
    "outcomes",
    ["action_seq", "revisions"],
    """WITH e AS (SELECT *, event_id AS x, revision AS latest_revision,
                  revision - CASE WHEN event_id % 71 = 0 THEN 1 ELSE 0 END AS named FROM action_seq
           WHERE status = 'in progress' AND event_id % 2 = 0)
SELECT e.x AS outcome_id, e.action_id, e.named AS revision, e.latest_revision, e.created_at,
       CASE WHEN e.x % 73 = 0 THEN 'guess' WHEN e.x % 4 = 0 THEN 'simulated' ELSE 'user_entered' END AS kind,
       r.measurement_start + CASE WHEN e.x % 3 = 0 THEN 1 ELSE 0 END AS window_start,
       r.measurement_end + CASE WHEN e.x % 79 = 0 THEN 5 ELSE 0 END AS window_end,
       r.measurement_start, r.measurement_end, r.primary_metric, r.target, r.satisfaction_min, r.late_delivery_max,
       1.0 + e.x % 5 AS score, CASE WHEN e.x % 83 <> 0 THEN (e.x % 10) / 10.0 END AS late,
       CASE WHEN r.primary_metric = 'satisfaction_score' THEN 1.0 + e.x % 5 WHEN r.primary_metric IS NOT NULL THEN (e.x % 100) / 100.0 END AS v
FROM e LEFT JOIN revisions r ON r.action_id = e.action_id AND r.revision = e.named""",
)


def _broken_sql(rules: dict[str, str]) -> str:
    """Names of the rules whose condition holds or cannot be decided."""
    return "concat_ws('; ', " + ", ".join(f"CASE WHEN coalesce({c}, true) THEN '{n}' END" for n, c in rules.items()) + ")"


_PLAN_SQL = f"""SELECT action_id, revision, {_broken_sql({
    'every text is filled in': "trim(owner) = ''",
    'all four dates are given': 'start_date IS NULL OR end_date IS NULL',
    'pilot does not end before it starts': 'end_date < start_date',
    'measurement does not end before it starts': 'measurement_end < measurement_start',
    'measurement lies inside the pilot': 'NOT (measurement_start >= start_date AND measurement_end <= end_date)',
    'pilot starts after the baseline month': "start_date < DATE '2026-01-01'",
    'metric is known': "primary_metric = 'footfall'",
    'target suits the metric': '''CASE primary_metric WHEN 'labour_cost_pct' THEN target NOT BETWEEN 0 AND 1
        WHEN 'waste_pct' THEN target NOT BETWEEN 0 AND 1 WHEN 'operating_margin_pct' THEN target NOT BETWEEN -1 AND 1
        WHEN 'satisfaction_score' THEN target NOT BETWEEN 1 AND 5 WHEN 'revenue' THEN target < 0 ELSE false END''',
    'score guardrail is a score': 'satisfaction_min NOT BETWEEN 1 AND 5',
    'late guardrail is a share': 'late_delivery_max NOT BETWEEN 0 AND 1',
})} AS broken_rules FROM revisions"""


@query(
    "e04_plan_contract",
    typed(
        with_ctes(["revisions"], f"SELECT *, broken_rules = '' AS valid FROM ({_PLAN_SQL})"),
        "action_id:i, revision:i, broken_rules:s, valid:b",
    ),
)
def e04_plan_contract(ctx):
    """Every revision's measurement plan with the contract rules it breaks."""
    return contracts.plan_contract(ctx.action_revisions).select("action_id", "revision", "broken_rules", "valid")


_PROPOSAL_SQL = f"""SELECT action_id, restaurant_id, period, {_broken_sql({
    'site id is positive': 'restaurant_id <= 0',
    'period is a month': "period NOT SIMILAR TO '[0-9]{4}-(0[1-9]|1[0-2])'",
    'site name is filled in': "trim(restaurant_name) = ''",
    'baseline reproduces its profit': '''NOT sound OR abs(revenue - ingredient_cost - waste_cost - commission_cost - labour_cost
        - campaign_cost - overhead_cost - operating_profit) > 0.010000001''',
    'source has a fingerprint': 'action_id % 23 = 0',
    'source is of the same period': "action_id % 29 = 0",
    'source is synthetic history': 'action_id % 31 = 0',
})} AS broken_rules FROM proposals"""


@query(
    "e10_proposal_contract",
    typed(
        with_ctes(["proposals"], f"SELECT *, broken_rules = '' AS valid FROM ({_PROPOSAL_SQL})"),
        "action_id:i, restaurant_id:i, period:s, broken_rules:s, valid:b",
    ),
)
def e10_proposal_contract(ctx):
    """Proposals with their frozen baseline and source checked."""
    return contracts.proposal_contract(ctx.action_proposals).select(
        "action_id", "restaurant_id", "period", "broken_rules", "valid"
    )


@query(
    "e10_draft_plans",
    typed(
        with_ctes(
            ["proposals"],
            """SELECT action_id, restaurant_id, period,
       CASE WHEN period = '2025-12' THEN DATE '2026-01-01' END AS start_date, CASE WHEN period = '2025-12' THEN DATE '2026-01-31' END AS end_date,
       CASE WHEN period = '2025-12' THEN DATE '2026-01-01' END AS measurement_start, CASE WHEN period = '2025-12' THEN DATE '2026-01-31' END AS measurement_end,
       'labour_cost_pct' AS primary_metric, CASE WHEN sound THEN 0.99 * labour_cost / revenue END AS target
FROM proposals""",
        ),
        "action_id:i, restaurant_id:i, period:s, start_date:t, end_date:t, measurement_start:t, measurement_end:t, "
        "primary_metric:s, target:d",
    ),
)
def e10_draft_plans(ctx):
    """Default plan of every proposal for one per cent fewer paid hours."""
    return contracts.draft_plans(ctx.action_proposals, Scenario(hours_change=-0.01))


_OUTCOME_SQL = f"""SELECT outcome_id, action_id, revision, {_broken_sql({
    'action is in progress': 'false',
    'revision is the latest': 'revision < latest_revision',
    'kind is known': "kind = 'guess'",
    'window lies inside the measurement': 'NOT (window_start <= window_end AND window_start >= measurement_start AND window_end <= measurement_end)',
    'metrics are those of the plan': 'primary_metric IS NULL OR late IS NULL',
    'service metrics are in range': 'score NOT BETWEEN 1 AND 5 OR late NOT BETWEEN 0 AND 1 OR late IS NULL',
    'primary value suits the metric': '''v IS NULL OR (primary_metric IN ('labour_cost_pct', 'waste_pct') AND v NOT BETWEEN 0 AND 1)
        OR (primary_metric = 'operating_margin_pct' AND v NOT BETWEEN -1 AND 1) OR (primary_metric = 'satisfaction_score' AND v NOT BETWEEN 1 AND 5)
        OR (primary_metric = 'revenue' AND v < 0)''',
})} AS broken_rules FROM outcomes"""


@query(
    "e09_outcome_contract",
    typed(
        with_ctes(["outcomes"], f"SELECT *, broken_rules = '' AS valid FROM ({_OUTCOME_SQL})"),
        "outcome_id:i, action_id:i, revision:i, broken_rules:s, valid:b",
    ),
)
def e09_outcome_contract(ctx):
    """Recorded outcomes with the contract rules they break."""
    out = contracts.outcome_contract(ctx.action_outcomes, ctx.action_revisions)
    return out.select("outcome_id", "action_id", "revision", "broken_rules", "valid")


@query(
    "e05_completion_gate",
    typed(
        with_ctes(
            ["action_seq", "outcomes"],
            """SELECT action_id, event_id, sequence, revision, EXISTS (
         SELECT 1 FROM outcomes o WHERE o.action_id = s.action_id AND o.revision = s.revision AND o.created_at <= s.created_at
           AND o.window_start = o.measurement_start AND o.window_end = o.measurement_end) AS allowed
FROM action_seq s WHERE status = 'completed'""",
        ),
        "action_id:i, event_id:i, sequence:i, revision:i, allowed:b",
    ),
)
def e05_completion_gate(ctx):
    """Completions and whether a full-window outcome of their revision came before."""
    return contracts.completion_gate(ctx.sequenced_events, ctx.action_outcomes, ctx.action_revisions)


@query(
    "e06_outcome_reviews",
    typed(
        with_ctes(
            ["outcomes", "proposals"],
            """SELECT o.outcome_id, o.action_id, o.revision, o.primary_metric, v AS recorded_value, target,
       CASE WHEN primary_metric IN ('labour_cost_pct', 'waste_pct') THEN v <= target ELSE v >= target END AS target_met,
       score >= satisfaction_min AND late <= late_delivery_max AS guardrails_met,
       window_start = measurement_start AND window_end = measurement_end AS window_complete,
       CASE kind WHEN 'simulated' THEN 'Simulated' WHEN 'user_entered' THEN 'Entered by a user, not verified' END AS classification,
       CASE primary_metric WHEN 'labour_cost_pct' THEN p.labour_cost_pct WHEN 'waste_pct' THEN p.waste_pct
         WHEN 'operating_margin_pct' THEN p.operating_margin_pct WHEN 'satisfaction_score' THEN p.satisfaction_score
         WHEN 'operating_profit' THEN p.operating_profit WHEN 'revenue' THEN p.revenue END AS baseline_value
FROM outcomes o LEFT JOIN proposals p USING (action_id)""",
        ),
        "outcome_id:i, action_id:i, revision:i, primary_metric:s, recorded_value:d, target:d, target_met:b, "
        "guardrails_met:b, window_complete:b, classification:s, baseline_value:d",
    ),
)
def e06_outcome_reviews(ctx):
    """Recorded values against the plan they were recorded under."""
    return contracts.outcome_reviews(ctx.action_outcomes, ctx.action_revisions, ctx.action_proposals)


@query(
    "e08_action_register",
    typed(
        with_ctes(
            ["action_seq", "revisions", "outcomes", "proposals"],
            """WITH s AS (SELECT action_id, arg_max(status, sequence) AS status, count(*) AS events FROM action_seq GROUP BY 1),
n AS (SELECT action_id, max(revision) AS revision FROM revisions GROUP BY 1),
r AS (SELECT revisions.* FROM revisions JOIN n USING (action_id, revision)),
u AS (SELECT action_id, count(*) AS outcomes FROM outcomes GROUP BY 1)
SELECT p.action_id, p.restaurant_id, p.restaurant_name, p.period AS baseline_month, s.status,
       s.status IN ('completed', 'cancelled') AS is_closed, s.events, r.revision, r.owner,
       CASE WHEN sound THEN (revenue - commission_cost) * (1 + price_change) - ingredient_cost - waste_cost
            - labour_cost * (1 + hours_change) - campaign_cost - overhead_cost - operating_profit END AS scenario_profit_delta,
       coalesce(u.outcomes, 0) AS outcomes
FROM proposals p LEFT JOIN s ON s.action_id = p.action_id LEFT JOIN r ON r.action_id = p.action_id
LEFT JOIN u ON u.action_id = p.action_id""",
        ),
        "action_id:i, restaurant_id:i, restaurant_name:s, baseline_month:s, status:s, is_closed:b, events:i, revision:i, "
        "owner:s, scenario_profit_delta:d, outcomes:i",
    ),
)
def e08_action_register(ctx):
    """Register of actions: site, status, latest revision, owner, estimate, outcomes."""
    return contracts.register(ctx.sequenced_events, ctx.action_revisions, ctx.action_outcomes, ctx.action_proposals)
