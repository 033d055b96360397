"""DuckDB SQL text for the oracle: input shaping CTEs plus output typing.

The shaping CTEs restate :mod:`opsledger.sources.adapters` in SQL (same fixed
values).  Operator SQL built on top of them is written from the formulas, not
from the Spark code.
"""

from __future__ import annotations

FOLD = (
    "(DATE '2024-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST({c} AS DATE)) % 731 AS INTEGER))"
)


def fold(c: str) -> str:
    return FOLD.format(c=c)


def snap(c: str, places: int = 6) -> str:
    scale = f"{10**places}.0::DOUBLE"
    return f"(round(({c}) * {scale}) / {scale})"


def msum(c: str) -> str:
    """Exact sum of cent amounts (integer cents, one conversion)."""
    return f"(CAST(sum(CAST(round({c} * 100) AS BIGINT)) AS DOUBLE) / 100.0::DOUBLE)"


CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


cte(
    "restaurants",
    [],
    """SELECT n.n_nationkey AS restaurant_id, n.n_name AS restaurant_name, r.r_name AS state,
       r.r_name AS location_type, r.r_name AS area
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
)
cte(
    "products",
    [],
    """SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
       p_retailprice AS menu_price_ex_gst,
       CAST((CAST(round(p_retailprice * 100) AS BIGINT) * 3 + 5) // 10 AS DOUBLE) / 100 AS standard_ingredient_cost
FROM part""",
)
cte(
    "osite",
    [],
    f"""SELECT o.o_orderkey AS order_id, c.c_nationkey AS restaurant_id,
       {fold('o.o_orderdate')} AS business_date,
       CAST(11 + o.o_orderkey % 11 AS INTEGER) AS hour, CAST(o.o_orderkey % 60 AS INTEGER) AS minute,
       CASE o.o_orderstatus WHEN 'F' THEN 'Dine-in' WHEN 'O' THEN 'Takeaway' ELSE 'Delivery' END AS channel,
       CASE WHEN o.o_custkey % 5 = 0 THEN NULL ELSE o.o_custkey END AS customer_id,
       o.o_orderstatus
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
)
cte(
    "lines",
    [],
    """SELECT *, l_orderkey * 1000000 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber,
          l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
          l_linestatus, l_shipdate) AS transaction_line_id,
       CAST(round(l_extendedprice * 100) AS BIGINT) AS p_c,
       (CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(round(l_discount * 100) AS BIGINT) + 50) // 100 AS d_c
FROM lineitem""",
)
cte(
    "sales_lines",
    ["lines", "osite", "restaurants"],
    """SELECT l.transaction_line_id, s.order_id, s.restaurant_id, r.restaurant_name,
       CAST(s.business_date AS TIMESTAMP) + to_hours(s.hour) + to_minutes(s.minute) AS timestamp_local,
       s.business_date, strftime(s.business_date, '%Y-%m') AS month, s.hour,
       CASE WHEN s.hour < 16 THEN 'Lunch' ELSE 'Dinner' END AS daypart,
       l.l_partkey AS product_id, CAST(l.l_quantity AS INTEGER) AS quantity, s.channel, s.customer_id,
       CAST(NULL AS VARCHAR) AS promotion_id,
       CAST(l.p_c AS DOUBLE) / 100 AS list_revenue,
       CAST(l.d_c AS DOUBLE) / 100 AS discount_amount,
       CAST(l.p_c - l.d_c AS DOUBLE) / 100 AS net_revenue,
       CAST((l.p_c - l.d_c + 5) // 10 AS DOUBLE) / 100 AS gst_amount,
       CAST((l.p_c * 3 + 5) // 10 AS DOUBLE) / 100 AS ingredient_cost,
       l.l_returnflag, l.l_linestatus
FROM lines l JOIN osite s ON l.l_orderkey = s.order_id
JOIN restaurants r ON s.restaurant_id = r.restaurant_id""",
)
cte(
    "raw_transactions",
    ["sales_lines"],
    """WITH raw AS (
  SELECT transaction_line_id,
         CASE WHEN transaction_line_id % 101 = 0 THEN NULL ELSE order_id END AS order_id,
         restaurant_id,
         CASE WHEN transaction_line_id % 61 = 0 THEN lower(restaurant_name) ELSE restaurant_name END AS restaurant_name,
         CASE WHEN transaction_line_id % 97 = 0 THEN 'not a time'
              ELSE strftime(timestamp_local, '%Y-%m-%d %H:%M:%S') END AS timestamp_local,
         CASE WHEN transaction_line_id % 89 = 0 THEN NULL ELSE product_id END AS product_id,
         CASE WHEN transaction_line_id % 83 = 0 THEN 999 ELSE quantity END AS quantity,
         CASE WHEN transaction_line_id % 73 = 0 THEN 'dine in' ELSE channel END AS channel,
         customer_id, promotion_id, list_revenue, discount_amount,
         CASE WHEN transaction_line_id % 79 = 0 THEN -900.0 ELSE net_revenue END AS net_revenue,
         gst_amount, ingredient_cost
  FROM sales_lines)
SELECT * FROM raw UNION ALL SELECT * FROM raw WHERE transaction_line_id % 67 = 0""",
)
_LABOUR_COLS = """s.order_id AS shift_id, s.restaurant_id, 'E' || CAST(s.order_id % 97 AS VARCHAR) AS employee_id,
       CASE s.order_id % 3 WHEN 0 THEN 'Service' WHEN 1 THEN 'Kitchen' ELSE 'Manager' END AS role,
       s.business_date,
       CASE WHEN 11 + s.order_id % 6 < 16 THEN 'Lunch' ELSE 'Dinner' END AS daypart,
       CAST(s.business_date AS TIMESTAMP) + to_hours(CAST(11 + s.order_id % 6 AS INTEGER)) AS scheduled_start,
       CAST(s.business_date AS TIMESTAMP) + to_hours(CAST(11 + s.order_id % 6 + 2 + s.order_id % 4 AS INTEGER)) AS scheduled_end,
       CAST(s.business_date AS TIMESTAMP) + to_hours(CAST(11 + s.order_id % 6 AS INTEGER)) + to_minutes(s.minute) AS actual_start,
       CAST(s.business_date AS TIMESTAMP) + to_hours(CAST(11 + s.order_id % 6 + 2 + s.order_id % 4 AS INTEGER)) + to_minutes(s.minute) AS actual_end,
       0.5::DOUBLE AS break_hours"""
_RATE = "CASE s.order_id % 3 WHEN 0 THEN 30.0 WHEN 1 THEN 34.0 ELSE 39.0 END::DOUBLE"
_PAID = "CAST(2 + s.order_id % 4 AS DOUBLE) - 0.5"
cte(
    "raw_labour",
    ["osite"],
    f"""SELECT {_LABOUR_COLS},
       CASE WHEN s.order_id % 29 = 0 THEN {_PAID} + 1.0 ELSE {_PAID} END AS paid_hours,
       CASE WHEN s.order_id % 41 = 0 THEN NULL ELSE {_RATE} END AS hourly_cost
FROM osite s""",
)
cte(
    "survey_log",
    ["osite"],
    """SELECT order_id AS feedback_id, order_id, restaurant_id, business_date,
       CASE WHEN order_id % 7 = 0 THEN NULL ELSE CAST(1 + order_id % 5 AS DOUBLE) END AS overall_score,
       CAST(1 + (order_id // 3) % 5 AS DOUBLE) AS food_score,
       CAST(1 + (order_id // 7) % 5 AS DOUBLE) AS service_score
FROM osite WHERE order_id % 3 = 0""",
)
cte(
    "raw_customer_feedback",
    ["survey_log"],
    """SELECT feedback_id, order_id, restaurant_id, business_date,
       CASE WHEN order_id % 53 = 0 THEN 9.0 ELSE overall_score END AS overall_score, food_score, service_score
FROM survey_log""",
)
cte(
    "raw_loyalty",
    ["osite"],
    """SELECT order_id * 2 AS loyalty_event_id, customer_id, restaurant_id, order_id, business_date AS event_date,
       CASE WHEN order_id % 12 = 0 THEN 'Redeem' ELSE 'Earn' END AS event_type,
       CASE WHEN order_id % 12 = 0 THEN -50 ELSE 10 END AS points
FROM osite WHERE customer_id IS NOT NULL
UNION ALL
SELECT order_id * 2 + 1, customer_id, restaurant_id, order_id, business_date, 'Enroll', 0
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY business_date, order_id) AS rn
      FROM osite WHERE customer_id IS NOT NULL) WHERE rn = 1""",
)
cte(
    "waste_log",
    ["sales_lines"],
    """SELECT transaction_line_id AS waste_id, restaurant_id, product_id, business_date, quantity AS waste_units,
       CAST((CAST(round(list_revenue * 100) AS BIGINT) * 2 + 50) // 100 AS DOUBLE) / 100 AS waste_cost,
       CASE WHEN l_linestatus = 'F' THEN 'Spoilage' ELSE 'Overproduction' END AS reason
FROM sales_lines WHERE l_returnflag = 'R'""",
)
cte(
    "raw_waste",
    ["waste_log"],
    """SELECT waste_id, restaurant_id, product_id, business_date,
       CASE WHEN waste_id % 31 = 0 THEN -waste_units ELSE waste_units END AS waste_units, waste_cost, reason
FROM waste_log""",
)
cte(
    "raw_delivery",
    ["osite", "lines"],
    """SELECT s.order_id, s.restaurant_id, 40.0::DOUBLE AS promised_minutes,
       CAST(25 + s.order_id % 40 AS DOUBLE) AS actual_minutes,
       CAST((coalesce(n.net_c, 0) * 25 + 50) // 100 AS DOUBLE) / 100 AS commission_cost,
       5.0::DOUBLE AS delivery_fee, 'Delivered' AS status
FROM osite s LEFT JOIN (SELECT l_orderkey, sum(p_c - d_c) AS net_c FROM lines GROUP BY l_orderkey) n
  ON s.order_id = n.l_orderkey
WHERE s.o_orderstatus = 'P'""",
)
cte(
    "promotions",
    ["restaurants"],
    """WITH slots(y, m, cost, rate, name, cat) AS (VALUES
   (2024, 3, 420.0, 0.10, 'Autumn lunch', 'STANDARD'), (2024, 6, 650.0, 0.15, 'Winter warmers', 'MEDIUM'),
   (2024, 10, 520.0, 0.20, 'Spring share', 'LARGE'), (2025, 3, 420.0, 0.10, 'Autumn lunch', 'STANDARD'),
   (2025, 6, 650.0, 0.15, 'Winter warmers', 'MEDIUM'), (2025, 10, 520.0, 0.20, 'Spring share', 'LARGE'))
SELECT printf('P%d%02d-%02d', y, m, restaurant_id) AS promotion_id, restaurant_id, name AS campaign_name,
       CAST(make_date(y, m, 4) + CAST(restaurant_id % 3 * 21 AS INTEGER) AS DATE) AS start_date,
       CAST(make_date(y, m, 4) + CAST(restaurant_id % 3 * 21 + 13 AS INTEGER) AS DATE) AS end_date,
       CAST(rate AS DOUBLE) AS discount_rate, cat AS eligible_category, CAST(cost AS DOUBLE) AS campaign_cost
FROM restaurants, slots""",
)
cte(
    "months",
    ["restaurants"],
    """SELECT restaurant_id, strftime(CAST(DATE '2024-01-01' + to_months(k) AS DATE), '%Y-%m') AS month
FROM restaurants, range(24) t(k)""",
)
cte(
    "targets",
    ["months"],
    """SELECT restaurant_id, month, 3000000.0::DOUBLE + restaurant_id * 100000.0::DOUBLE AS revenue_target,
       0.60::DOUBLE + restaurant_id * 0.002::DOUBLE AS operating_margin_target,
       0.001::DOUBLE AS labour_pct_target, 0.01::DOUBLE AS waste_pct_target, 3.5::DOUBLE AS satisfaction_target
FROM months""",
)
cte(
    "operating_costs",
    ["months"],
    """SELECT restaurant_id * 100000 + CAST(replace(month, '-', '') AS INTEGER) % 10000 * 10 + 1 AS cost_id,
       restaurant_id, month, 'Rent' AS cost_category, 20000.0::DOUBLE + restaurant_id * 500.0::DOUBLE AS amount
FROM months
UNION ALL
SELECT restaurant_id * 100000 + CAST(replace(month, '-', '') AS INTEGER) % 10000 * 10 + 2,
       restaurant_id, month, 'Utilities', 4000.0::DOUBLE + restaurant_id * 100.0::DOUBLE
FROM months""",
)
cte(
    "calendar",
    ["restaurants"],
    """SELECT d AS business_date, state,
       CASE WHEN month(d) = 1 AND day(d) = 1 THEN 'New Year''s Day'
            WHEN month(d) = 12 AND day(d) = 25 THEN 'Christmas Day' END AS holiday_name,
       CASE WHEN (month(d) = 1 AND day(d) = 1) OR (month(d) = 12 AND day(d) = 25) THEN 1 ELSE 0 END AS is_public_holiday,
       isodow(d) - 1 AS weekday, CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend,
       month(d) AS month,
       CASE WHEN month(d) IN (12, 1, 2) THEN 'Summer' WHEN month(d) IN (3, 4, 5) THEN 'Autumn'
            WHEN month(d) IN (6, 7, 8) THEN 'Winter' ELSE 'Spring' END AS season,
       CASE WHEN month(d) IN (1, 7, 12) OR (month(d) IN (4, 10) AND day(d) <= 14) THEN 1 ELSE 0 END AS school_holiday_proxy
FROM (SELECT DISTINCT state FROM restaurants) s,
     (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2025-12-31', INTERVAL 1 DAY)) AS DATE) AS d) g""",
)
# ---- the cleaning flow: what the marts are built on ------------------------
cte(
    "flagged",
    ["raw_transactions", "products"],
    """WITH d AS (SELECT DISTINCT * FROM raw_transactions),
p AS (SELECT DISTINCT product_id AS pid FROM products),
t AS (SELECT d.*, p.pid, try_strptime(d.timestamp_local, '%Y-%m-%d %H:%M:%S') AS ts
      FROM d LEFT JOIN p ON d.product_id = p.pid),
r AS (SELECT t.*,
  coalesce(order_id IS NULL, true) AS r0,
  coalesce(pid IS NULL, true) AS r1,
  coalesce(ts IS NULL OR NOT ts BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2025-12-31 23:59:59', true) AS r2,
  coalesce(ts IS NOT NULL AND NOT hour(ts) BETWEEN 11 AND 21, true) AS r3,
  coalesce(NOT quantity BETWEEN 1 AND 50, true) AS r4,
  coalesce(isnan(net_revenue) OR isinf(net_revenue) OR net_revenue < 0
        OR isnan(list_revenue) OR isinf(list_revenue) OR list_revenue < 0
        OR isnan(discount_amount) OR isinf(discount_amount) OR discount_amount < 0
        OR isnan(gst_amount) OR isinf(gst_amount) OR gst_amount < 0
        OR isnan(ingredient_cost) OR isinf(ingredient_cost) OR ingredient_cost < 0
        OR discount_amount > list_revenue, true) AS r5,
  coalesce(NOT coalesce(channel IN ('Dine-in', 'Takeaway', 'Delivery'), false), true) AS r6,
  coalesce(abs(list_revenue - discount_amount - net_revenue) > 0.011, true) AS r7,
  coalesce(abs(net_revenue * 0.10 - gst_amount) > 0.011, true) AS r8
FROM t)
SELECT *, (r0 OR r1 OR r2 OR r3 OR r4 OR r5 OR r6 OR r7 OR r8) AS invalid,
  concat(CASE WHEN r0 THEN 'Missing order identifier; ' ELSE '' END,
         CASE WHEN r1 THEN 'Invalid product foreign key; ' ELSE '' END,
         CASE WHEN r2 THEN 'Invalid timestamp; ' ELSE '' END,
         CASE WHEN r3 THEN 'Outside trading hours; ' ELSE '' END,
         CASE WHEN r4 THEN 'Invalid quantity; ' ELSE '' END,
         CASE WHEN r5 THEN 'Invalid monetary values; ' ELSE '' END,
         CASE WHEN r6 THEN 'Invalid channel category; ' ELSE '' END,
         CASE WHEN r7 THEN 'Revenue reconciliation; ' ELSE '' END,
         CASE WHEN r8 THEN 'GST reconciliation; ' ELSE '' END) AS reasons
FROM r""",
)
cte(
    "bad_orders",
    ["flagged"],
    "SELECT DISTINCT order_id FROM flagged WHERE invalid AND order_id IS NOT NULL",
)
cte(
    "quarantined",
    ["flagged", "bad_orders"],
    """SELECT *, CASE WHEN reasons = '' THEN 'Other line of a rejected order' ELSE reasons END AS quality_reason
FROM flagged WHERE order_id IS NULL OR order_id IN (SELECT order_id FROM bad_orders)""",
)
cte(
    "clean_lines",
    ["flagged", "bad_orders"],
    "SELECT * FROM flagged WHERE order_id IS NOT NULL AND order_id NOT IN (SELECT order_id FROM bad_orders)",
)
cte(
    "transactions",
    ["clean_lines", "restaurants"],
    """SELECT l.transaction_line_id, l.order_id, l.restaurant_id, r.restaurant_name, l.ts AS timestamp_local,
       CAST(l.ts AS DATE) AS business_date, strftime(l.ts, '%Y-%m') AS month, CAST(hour(l.ts) AS INTEGER) AS hour,
       CASE WHEN hour(l.ts) < 16 THEN 'Lunch' ELSE 'Dinner' END AS daypart, l.product_id, l.quantity, l.channel,
       l.customer_id, l.promotion_id, l.net_revenue, l.list_revenue, l.discount_amount, l.gst_amount, l.ingredient_cost
FROM clean_lines l LEFT JOIN restaurants r ON r.restaurant_id = l.restaurant_id""",
)
cte(
    "repaired_labour",
    ["raw_labour", "restaurants", "calendar"],
    """WITH l AS (
  SELECT *, date_diff('second', actual_start, actual_end) / 3600.0 - break_hours AS worked FROM raw_labour),
k AS (
  SELECT l.*, coalesce(paid_hours < 0 OR paid_hours > 16 OR abs(paid_hours - worked) > 0.01, false) AS hours_repaired,
         c.weekday > 4 AS weekend, c.is_public_holiday AS holiday
  FROM l JOIN restaurants s USING (restaurant_id)
  JOIN calendar c ON c.business_date = l.business_date AND c.state = s.state),
m AS (SELECT role, weekend, holiday, quantile_cont(hourly_cost, 0.5) AS usual FROM k GROUP BY role, weekend, holiday)
SELECT k.* EXCLUDE (paid_hours, hourly_cost, worked, weekend, holiday),
       CASE WHEN hours_repaired THEN worked ELSE paid_hours END AS paid_hours, ifnull(hourly_cost, usual) AS hourly_cost,
       CAST(hourly_cost IS NULL AS INTEGER) AS rate_imputed,
       round_even((CASE WHEN hours_repaired THEN worked ELSE paid_hours END) * ifnull(hourly_cost, usual), 2) AS labour_cost
FROM k LEFT JOIN m USING (role, weekend, holiday)""",
)
cte("labour", ["repaired_labour"], "SELECT * EXCLUDE (hours_repaired) FROM repaired_labour")
cte("waste", ["raw_waste"], "SELECT * FROM raw_waste WHERE waste_units >= 0 AND waste_cost >= 0")
cte(
    "customer_feedback",
    ["raw_customer_feedback", "clean_lines"],
    """SELECT feedback_id, CASE WHEN order_id IN (SELECT order_id FROM clean_lines) THEN order_id END AS order_id, restaurant_id,
       business_date, CASE WHEN overall_score >= 1 AND overall_score <= 5 THEN overall_score END AS overall_score,
       food_score, service_score
FROM raw_customer_feedback""",
)
cte("delivery", ["raw_delivery", "clean_lines"], "SELECT * FROM raw_delivery WHERE order_id IN (SELECT order_id FROM clean_lines)")
cte(
    "loyalty",
    ["raw_loyalty", "clean_lines"],
    "SELECT * FROM raw_loyalty WHERE order_id IS NULL OR order_id IN (SELECT order_id FROM clean_lines)",
)
# ---- marts written from the formulas ---------------------------------------
cte(
    "orders_mart",
    ["transactions"],
    f"""SELECT order_id, min(restaurant_id) AS restaurant_id, min(business_date) AS business_date,
       min(timestamp_local) AS timestamp_local, min(hour) AS hour, min(daypart) AS daypart,
       min(channel) AS channel, min(customer_id) AS customer_id, min(promotion_id) AS promotion_id,
       sum(net_revenue) AS revenue, sum(ingredient_cost) AS ingredient_cost,
       sum(discount_amount) AS discount_amount, sum(quantity) AS units
FROM transactions GROUP BY order_id""",
)
cte(
    "store_day",
    ["restaurants", "calendar", "orders_mart", "labour", "waste", "customer_feedback", "delivery",
     "operating_costs", "promotions"],
    f"""SELECT r.restaurant_id, r.restaurant_name, r.state, r.location_type, r.area,
       c.business_date, c.holiday_name, c.is_public_holiday, c.weekday, c.is_weekend, c.season,
       c.school_holiday_proxy, strftime(c.business_date, '%Y-%m') AS month,
       coalesce(s.revenue, 0) AS revenue, coalesce(s.ingredient_cost, 0) AS ingredient_cost,
       coalesce(s.transactions, 0) AS transactions, coalesce(s.discounts, 0) AS discounts,
       coalesce(s.identified_orders, 0) AS identified_orders,
       coalesce(l.labour_cost, 0) AS labour_cost, coalesce(l.paid_hours, 0) AS paid_hours,
       coalesce(l.service_hours, 0) AS service_hours,
       coalesce(w.waste_cost, 0) AS waste_cost,
       coalesce(f.score_sum, 0) AS score_sum, coalesce(f.survey_responses, 0) AS survey_responses,
       coalesce(d.commission_cost, 0) AS commission_cost, coalesce(d.deliveries, 0) AS deliveries,
       coalesce(d.late_deliveries, 0) AS late_deliveries,
       oc.monthly_overheads, oc.monthly_overheads / day(last_day(c.business_date)) AS overhead_cost,
       pc.promotion_id, coalesce(pc.campaign_cost, 0.0) AS campaign_cost
FROM restaurants r JOIN calendar c ON r.state = c.state
LEFT JOIN (SELECT restaurant_id, business_date, {msum('revenue')} AS revenue, {msum('ingredient_cost')} AS ingredient_cost,
                  count(*) AS transactions, {msum('discount_amount')} AS discounts, count(customer_id) AS identified_orders
           FROM orders_mart GROUP BY ALL) s
  ON s.restaurant_id = r.restaurant_id AND s.business_date = c.business_date
LEFT JOIN (SELECT restaurant_id, business_date, {msum('labour_cost')} AS labour_cost, sum(paid_hours) AS paid_hours,
                  sum(CASE WHEN role = 'Service' THEN paid_hours END) AS service_hours
           FROM labour GROUP BY ALL) l
  ON l.restaurant_id = r.restaurant_id AND l.business_date = c.business_date
LEFT JOIN (SELECT restaurant_id, business_date, {msum('waste_cost')} AS waste_cost FROM waste GROUP BY ALL) w
  ON w.restaurant_id = r.restaurant_id AND w.business_date = c.business_date
LEFT JOIN (SELECT restaurant_id, business_date, sum(overall_score) AS score_sum,
                  count(overall_score) AS survey_responses FROM customer_feedback GROUP BY ALL) f
  ON f.restaurant_id = r.restaurant_id AND f.business_date = c.business_date
LEFT JOIN (SELECT dl.restaurant_id, o.business_date, {msum('dl.commission_cost')} AS commission_cost,
                  count(dl.order_id) AS deliveries,
                  count(*) FILTER (WHERE dl.actual_minutes > dl.promised_minutes) AS late_deliveries
           FROM delivery dl JOIN orders_mart o ON dl.order_id = o.order_id GROUP BY ALL) d
  ON d.restaurant_id = r.restaurant_id AND d.business_date = c.business_date
LEFT JOIN (SELECT restaurant_id, month, sum(amount) AS monthly_overheads FROM operating_costs GROUP BY ALL) oc
  ON oc.restaurant_id = r.restaurant_id AND oc.month = strftime(c.business_date, '%Y-%m')
LEFT JOIN (SELECT restaurant_id, CAST(dd AS DATE) AS business_date,
                  arg_max(promotion_id, (start_date, promotion_id)) AS promotion_id,
                  arg_max(campaign_cost / (end_date - start_date + 1), (start_date, promotion_id)) AS campaign_cost
           FROM promotions, unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) t(dd)
           GROUP BY ALL) pc
  ON pc.restaurant_id = r.restaurant_id AND pc.business_date = c.business_date""",
)
cte(
    "store_day_ledger",
    ["store_day"],
    """SELECT *, revenue - (ingredient_cost + waste_cost + labour_cost + commission_cost
                        + coalesce(overhead_cost, 0) + campaign_cost) AS operating_profit,
       score_sum / nullif(survey_responses, 0) AS satisfaction_score
FROM store_day""",
)


def with_ctes(names: list[str], body: str) -> str:
    """Prefix ``body`` with the named CTEs and their dependencies, in order."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} AS (\n{CTES[n][1]}\n)" for n in order]
    stripped = body.lstrip()
    if stripped[:4].upper() == "WITH":
        # merge the body's own CTE list into ours
        own = stripped[4:].lstrip()
        start = "WITH RECURSIVE " if own[:9].upper() == "RECURSIVE" else "WITH "
        return start + ",\n".join(parts) + ",\n" + (own[9:] if start != "WITH " else own).lstrip()
    return "WITH " + ",\n".join(parts) + "\n" + body


def typed(select_from: str, spec: str) -> str:
    """Final projection with the engine-neutral output types.

    ``spec`` is ``"name:t, ..."`` with t in d (double, rounded to 4 places),
    i (bigint), s (text), t (date), b (boolean), x (timestamp).
    """
    cols = []
    for item in spec.split(","):
        name, t = [p.strip() for p in item.split(":")]
        if t == "d":
            cols.append(f"round(CAST({name} AS DOUBLE) * 10000.0::DOUBLE) / 10000.0::DOUBLE + 0.0::DOUBLE AS {name}")
        elif t == "i":
            cols.append(f"CAST({name} AS BIGINT) AS {name}")
        elif t == "s":
            cols.append(f"CAST({name} AS VARCHAR) AS {name}")
        elif t == "t":
            cols.append(f"CAST({name} AS DATE) AS {name}")
        elif t == "b":
            cols.append(f"CAST({name} AS BOOLEAN) AS {name}")
        elif t == "x":
            cols.append(f"CAST({name} AS TIMESTAMP) AS {name}")
        else:
            raise ValueError(t)
    return f"SELECT {', '.join(cols)} FROM (\n{select_from}\n) q"
