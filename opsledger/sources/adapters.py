"""Shape the driver's TPC-H-like tables into the canonical operations facts.

These are deterministic column expressions, not operators: they give the
operators realistic inputs (sites, order lines, shifts, surveys, waste, ...).
Money is derived in integer cents so every engine computes the same values.

Fixed values of the mapping (they define the test data, keep them together):

* history: 2024-01-01 .. 2025-12-31 (731 days); every order date d maps to
  ``2024-01-01 + (days(d - 1995-01-01) mod 731)``;
* site = customer nation; peer group / state / area = region name;
* order hour = 11 + orderkey mod 11, minute = orderkey mod 60;
* channel: status F -> Dine-in, O -> Takeaway, P -> Delivery;
* anonymous customer when custkey mod 5 = 0;
* discount = round(list x l_discount, 2); net = list - discount;
  GST = round(0.1 x net, 2); ingredient cost = round(0.3 x list, 2);
* shifts: one per order, role by key mod 3 (Service, Kitchen, Manager),
  start 11 + key mod 6 h + key mod 60 min, length 2 + key mod 4 h, break 0.5 h,
  rates 30 / 34 / 39; raw variant leaves the rate empty when key mod 41 = 0;
* surveys: orders with key mod 3 = 0, score 1 + key mod 5, empty when key mod 7 = 0;
* loyalty: Earn per identified order, Redeem when key mod 12 = 0, Enroll on the
  first order of each customer;
* waste: lines with return flag R, cost round(0.02 x list, 2),
  reason F -> Spoilage, otherwise Overproduction;
* delivery: orders with status P, promised 40 min, actual 25 + key mod 40,
  commission round(0.25 x order net, 2), fee 5;
* campaigns: each site in months 3 / 6 / 10 of 2024 and 2025, start on day 4 +
  21 x (site mod 3), 14 days inclusive, cost 420 / 650 / 520,
  discount 0.10 / 0.15 / 0.20;
* public holidays: 1 January (New Year's Day) and 25 December (Christmas Day).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.semantics import broadcast_if_small, daypart, month_text
from . import tables

HISTORY_START = "2024-01-01"
HISTORY_END = "2025-12-31"
FOLD_BASE = "1995-01-01"
FOLD_DAYS = 731


def fold_date(ts: Column) -> Column:
    return F.date_add(
        F.lit(HISTORY_START).cast("date"),
        F.pmod(F.datediff(F.to_date(ts), F.lit(FOLD_BASE).cast("date")), F.lit(FOLD_DAYS)),
    )


def _ts(date: Column, hour: Column, minute: Column) -> Column:
    return F.make_timestamp_ntz(
        F.year(date), F.month(date), F.dayofmonth(date), hour, minute, F.lit(0)
    )


def _money(cents: Column) -> Column:
    return cents.cast("double") / F.lit(100.0)


@dataclass
class Source:
    """Driver tables of one scale factor."""

    spark: SparkSession
    folder: str
    # optional provider of a stored copy of ``build_order_sites()``
    order_sites_source: Callable[[], DataFrame] | None = None

    def t(self, name: str) -> DataFrame:
        return tables.read_parquet(self.spark, self.folder, name)

    # ---- dimensions -----------------------------------------------------
    def restaurants(self) -> DataFrame:
        n, r = self.t("nation"), self.t("region")
        return n.join(broadcast_if_small(r), n.n_regionkey == r.r_regionkey).select(
            n.n_nationkey.alias("restaurant_id"),
            n.n_name.alias("restaurant_name"),
            r.r_name.alias("state"),
            r.r_name.alias("location_type"),
            r.r_name.alias("area"),
            (F.lit(40) + (n.n_nationkey % 5) * 10).alias("seats"),
            F.lit(11).alias("open_hour"),
            F.lit(22).alias("close_hour"),
        )

    def products(self) -> DataFrame:
        p = self.t("part")
        return p.select(
            p.p_partkey.alias("product_id"),
            p.p_name.alias("product_name"),
            p.p_type.alias("category"),
            p.p_retailprice.alias("menu_price_ex_gst"),
            _money(F.expr("(cast(round(p_retailprice * 100) as bigint) * 3 + 5) div 10")).alias(
                "standard_ingredient_cost"
            ),
        )

    def calendar(self, start: str = HISTORY_START, end: str = HISTORY_END) -> DataFrame:
        from ..operators.marts import calendar as build_calendar

        states = self.restaurants().select("state").distinct()
        return build_calendar(states, start, end)

    # ---- order attributes -----------------------------------------------
    def order_sites(self) -> DataFrame:
        """One row per order: site, folded date, channel, customer."""
        if self.order_sites_source is not None:
            return self.order_sites_source()
        return self.build_order_sites()

    def build_order_sites(self) -> DataFrame:
        o, c = self.t("orders"), self.t("customer")
        j = o.join(c, o.o_custkey == c.c_custkey)
        key = F.col("o_orderkey")
        d = fold_date(F.col("o_orderdate"))
        return j.select(
            key.alias("order_id"),
            F.col("c_nationkey").alias("restaurant_id"),
            d.alias("business_date"),
            (F.lit(11) + key % 11).cast("int").alias("hour"),
            (key % 60).cast("int").alias("minute"),
            F.when(F.col("o_orderstatus") == "F", "Dine-in")
            .when(F.col("o_orderstatus") == "O", "Takeaway")
            .otherwise("Delivery")
            .alias("channel"),
            F.when(F.col("o_custkey") % 5 == 0, F.lit(None).cast("long"))
            .otherwise(F.col("o_custkey"))
            .alias("customer_id"),
            F.col("o_orderstatus"),
        )

    # ---- order lines ----------------------------------------------------
    def lines(self) -> DataFrame:
        """Lineitem with a per-order line number (tie-broken on every column)."""
        li = self.t("lineitem")
        w = Window.partitionBy("l_orderkey").orderBy(
            "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
        )
        return li.withColumn(
            "transaction_line_id", F.col("l_orderkey") * 1_000_000 + F.row_number().over(w)
        )

    def sale_rows(self) -> DataFrame:
        """Order lines with their order's attributes, money in cents: what :meth:`shaped` needs and no more."""
        li = self.lines()
        osite = self.order_sites()
        return li.join(osite, li.l_orderkey == osite.order_id).select(
            "transaction_line_id", "order_id", "restaurant_id", "business_date", "hour", "minute",
            F.col("l_partkey").alias("product_id"), F.col("l_quantity").cast("int").alias("quantity"), "channel", "customer_id",
            F.round(F.col("l_extendedprice") * 100).cast("long").alias("_p"),
            F.round(F.col("l_discount") * 100).cast("long").alias("_rate"),
            "l_returnflag", "l_linestatus",
        )

    def transactions(self) -> DataFrame:
        """Clean order lines (canonical ``transactions``)."""
        return self.shaped(self.sale_rows())

    def shaped(self, rows: DataFrame) -> DataFrame:
        """Canonical order lines of :meth:`sale_rows` (expressions and the site's name, no shuffle)."""
        stores = self.restaurants().select("restaurant_id", "restaurant_name")
        j = rows.join(broadcast_if_small(stores), "restaurant_id")
        j = j.withColumn("_d", F.expr("(_p * _rate + 50) div 100"))
        j = j.withColumn("_n", F.col("_p") - F.col("_d"))
        return j.select(
            "transaction_line_id",
            "order_id",
            "restaurant_id",
            "restaurant_name",
            _ts(F.col("business_date"), F.col("hour"), F.col("minute")).alias("timestamp_local"),
            "business_date",
            month_text(F.col("business_date")).alias("month"),
            "hour",
            daypart(F.col("hour")).alias("daypart"),
            "product_id",
            "quantity",
            "channel",
            "customer_id",
            F.lit(None).cast("string").alias("promotion_id"),
            _money(F.col("_p")).alias("list_revenue"),
            _money(F.col("_d")).alias("discount_amount"),
            _money(F.col("_n")).alias("net_revenue"),
            _money(F.expr("(_n + 5) div 10")).alias("gst_amount"),
            _money(F.expr("(_p * 3 + 5) div 10")).alias("ingredient_cost"),
            F.col("l_returnflag"),
            F.col("l_linestatus"),
        )

    def raw_transactions(self, clean: DataFrame | None = None) -> DataFrame:
        """Order lines as exported, with planted defects and exact duplicates.

        Defects by line id: mod 97 bad timestamp text, mod 89 missing product,
        mod 83 quantity 999, mod 79 net -900, mod 73 channel 'dine in',
        mod 101 missing order id; lines with id mod 67 = 0 are exported twice.
        """
        tx = clean if clean is not None else self.transactions()
        lid = F.col("transaction_line_id")
        raw = tx.select(
            "transaction_line_id",
            F.when(lid % 101 == 0, F.lit(None).cast("long")).otherwise(F.col("order_id")).alias("order_id"),
            "restaurant_id",
            F.when(lid % 61 == 0, F.lower(F.col("restaurant_name")))
            .otherwise(F.col("restaurant_name"))
            .alias("restaurant_name"),
            F.when(lid % 97 == 0, F.lit("not a time"))
            .otherwise(F.date_format("timestamp_local", "yyyy-MM-dd HH:mm:ss"))
            .alias("timestamp_local"),
            F.when(lid % 89 == 0, F.lit(None).cast("long")).otherwise(F.col("product_id")).alias("product_id"),
            F.when(lid % 83 == 0, F.lit(999)).otherwise(F.col("quantity")).alias("quantity"),
            F.when(lid % 73 == 0, F.lit("dine in")).otherwise(F.col("channel")).alias("channel"),
            "customer_id",
            "promotion_id",
            "list_revenue",
            "discount_amount",
            F.when(lid % 79 == 0, F.lit(-900.0)).otherwise(F.col("net_revenue")).alias("net_revenue"),
            "gst_amount",
            "ingredient_cost",
            # one pass: a union would compute the lines twice
            F.explode(F.when(lid % 67 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
        )
        return raw.drop("_copy")

    # ---- other facts ----------------------------------------------------
    def labour(self, raw: bool = False) -> DataFrame:
        o = self.order_sites()
        key = F.col("order_id")
        start_h = (F.lit(11) + key % 6).cast("int")
        length = (F.lit(2) + key % 4).cast("int")
        role = (
            F.when(key % 3 == 0, "Service").when(key % 3 == 1, "Kitchen").otherwise("Manager")
        )
        rate = F.when(key % 3 == 0, 30.0).when(key % 3 == 1, 34.0).otherwise(39.0)
        paid = length.cast("double") - F.lit(0.5)
        d = F.col("business_date")
        df = o.select(
            key.alias("shift_id"),
            "restaurant_id",
            F.concat(F.lit("E"), (key % 97).cast("string")).alias("employee_id"),
            role.alias("role"),
            d.alias("business_date"),
            daypart(start_h).alias("daypart"),
            _ts(d, start_h, F.lit(0)).alias("scheduled_start"),
            _ts(d, start_h + length, F.lit(0)).alias("scheduled_end"),
            _ts(d, start_h, F.col("minute")).alias("actual_start"),
            _ts(d, start_h + length, F.col("minute")).alias("actual_end"),
            F.lit(0.5).alias("break_hours"),
            (F.when(key % 29 == 0, paid + 1.0).otherwise(paid) if raw else paid).alias("paid_hours"),
            (F.when(key % 41 == 0, F.lit(None).cast("double")).otherwise(rate) if raw else rate).alias(
                "hourly_cost"
            ),
        )
        if raw:
            return df
        return df.withColumn("rate_imputed", F.lit(0)).withColumn(
            "labour_cost", F.bround(F.col("paid_hours") * F.col("hourly_cost"), 2)
        )

    def customer_feedback(self, raw: bool = False) -> DataFrame:
        o = self.order_sites().filter(F.col("order_id") % 3 == 0)
        key = F.col("order_id")
        score = F.when(key % 7 == 0, F.lit(None).cast("double")).otherwise(
            (F.lit(1) + key % 5).cast("double")
        )
        if raw:
            score = F.when(key % 53 == 0, F.lit(9.0)).otherwise(score)
        return o.select(
            key.alias("feedback_id"),
            key.alias("order_id"),
            "restaurant_id",
            "business_date",
            score.alias("overall_score"),
            (F.lit(1) + F.floor(key / 3) % 5).cast("double").alias("food_score"),
            (F.lit(1) + F.floor(key / 7) % 5).cast("double").alias("service_score"),
        )

    def loyalty(self) -> DataFrame:
        o = self.order_sites().filter(F.col("customer_id").isNotNull())
        key = F.col("order_id")
        events = o.select(
            (key * 2).alias("loyalty_event_id"),
            "customer_id",
            "restaurant_id",
            key.alias("order_id"),
            F.col("business_date").alias("event_date"),
            F.when(key % 12 == 0, "Redeem").otherwise("Earn").alias("event_type"),
            F.when(key % 12 == 0, -50).otherwise(10).alias("points"),
        )
        # first order per customer by (date, order id); partial aggregation, no window
        first = o.groupBy("customer_id").agg(
            F.min(F.struct("business_date", "order_id", "restaurant_id")).alias("f")
        )
        enroll = first.select(
            (F.col("f.order_id") * 2 + 1).alias("loyalty_event_id"),
            "customer_id",
            F.col("f.restaurant_id").alias("restaurant_id"),
            F.col("f.order_id").alias("order_id"),
            F.col("f.business_date").alias("event_date"),
            F.lit("Enroll").alias("event_type"),
            F.lit(0).alias("points"),
        )
        return events.unionByName(enroll)

    def waste(self, raw: bool = False, clean: DataFrame | None = None) -> DataFrame:
        tx = (clean if clean is not None else self.transactions()).filter(F.col("l_returnflag") == "R")
        lid = F.col("transaction_line_id")
        units = F.col("quantity")
        if raw:
            units = F.when(lid % 31 == 0, -F.col("quantity")).otherwise(units)
        return tx.select(
            lid.alias("waste_id"),
            "restaurant_id",
            "product_id",
            "business_date",
            units.alias("waste_units"),
            _money(F.expr("(cast(round(list_revenue * 100) as bigint) * 2 + 50) div 100")).alias(
                "waste_cost"
            ),
            F.when(F.col("l_linestatus") == "F", "Spoilage").otherwise("Overproduction").alias("reason"),
        )

    def delivery(self) -> DataFrame:
        o = self.order_sites().filter(F.col("o_orderstatus") == "P")
        li = self.t("lineitem")
        net = li.groupBy("l_orderkey").agg(
            F.sum(
                F.expr(
                    "cast(round(l_extendedprice * 100) as bigint) - "
                    "(cast(round(l_extendedprice * 100) as bigint) * cast(round(l_discount * 100) as bigint) + 50) div 100"
                )
            ).alias("net_cents")
        )
        j = o.join(net, o.order_id == net.l_orderkey, "left")
        key = F.col("order_id")
        return j.select(
            "order_id",
            "restaurant_id",
            F.lit(40.0).alias("promised_minutes"),
            (F.lit(25) + key % 40).cast("double").alias("actual_minutes"),
            _money(F.expr("(coalesce(net_cents, 0) * 25 + 50) div 100")).alias("commission_cost"),
            F.lit(5.0).alias("delivery_fee"),
            F.lit("Delivered").alias("status"),
        )

    def promotions(self) -> DataFrame:
        s = self.restaurants()
        slots = F.array(
            *[
                F.struct(F.lit(y).alias("y"), F.lit(m).alias("m"), F.lit(c).alias("cost"),
                         F.lit(r).alias("rate"), F.lit(n).alias("name"), F.lit(cat).alias("cat"))
                for y in (2024, 2025)
                for (m, c, r, n, cat) in (
                    (3, 420.0, 0.10, "Autumn lunch", "STANDARD"),
                    (6, 650.0, 0.15, "Winter warmers", "MEDIUM"),
                    (10, 520.0, 0.20, "Spring share", "LARGE"),
                )
            ]
        )
        e = s.select("restaurant_id", F.explode(slots).alias("c"))
        start = F.date_add(
            F.make_date(F.col("c.y"), F.col("c.m"), F.lit(4)), (F.col("restaurant_id") % 3) * 21
        )
        return e.select(
            F.format_string("P%d%02d-%02d", F.col("c.y"), F.col("c.m"), F.col("restaurant_id")).alias(
                "promotion_id"
            ),
            "restaurant_id",
            F.col("c.name").alias("campaign_name"),
            start.alias("start_date"),
            F.date_add(start, 13).alias("end_date"),
            F.col("c.rate").alias("discount_rate"),
            F.col("c.cat").alias("eligible_category"),
            F.col("c.cost").alias("campaign_cost"),
        )

    def months(self) -> DataFrame:
        """Sites x history months."""
        s = self.restaurants()
        return s.select(
            "restaurant_id", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("k")
        ).select(
            "restaurant_id",
            F.date_format(F.add_months(F.lit(HISTORY_START).cast("date"), F.col("k")), "yyyy-MM").alias("month"),
        )

    def targets(self) -> DataFrame:
        m = self.months()
        sid = F.col("restaurant_id")
        return m.select(
            "restaurant_id",
            "month",
            (F.lit(3000000.0) + sid * 100000.0).alias("revenue_target"),
            (F.lit(0.60) + sid * 0.002).alias("operating_margin_target"),
            F.lit(0.001).alias("labour_pct_target"),
            F.lit(0.01).alias("waste_pct_target"),
            F.lit(3.5).alias("satisfaction_target"),
        )

    def operating_costs(self) -> DataFrame:
        m = self.months()
        sid = F.col("restaurant_id")
        kinds = F.array(
            F.struct(F.lit(1).alias("k"), F.lit("Rent").alias("cat"), (F.lit(20000.0) + sid * 500.0).alias("amt")),
            F.struct(F.lit(2).alias("k"), F.lit("Utilities").alias("cat"), (F.lit(4000.0) + sid * 100.0).alias("amt")),
        )
        e = m.select("restaurant_id", "month", F.explode(kinds).alias("c"))
        return e.select(
            (sid * 100000 + F.regexp_replace("month", "-", "").cast("int") % 10000 * 10 + F.col("c.k"))
            .cast("long")
            .alias("cost_id"),
            "restaurant_id",
            "month",
            F.col("c.cat").alias("cost_category"),
            F.col("c.amt").alias("amount"),
        )

    # ---- action evidence log (fixed mapping: event type -> workflow status) --
    # view -> proposed, click -> approved, purchase -> in progress,
    # signup -> completed, error -> cancelled; action = user, note = props.
    ACTION_STATUS = {
        "view": "proposed",
        "click": "approved",
        "purchase": "in progress",
        "signup": "completed",
        "error": "cancelled",
    }

    def action_events(self) -> DataFrame:
        """Append-only status events (action_id, event_id, created_at, status, note)."""
        e = self.t("events")
        status = F.element_at(
            F.create_map(*[F.lit(x) for kv in self.ACTION_STATUS.items() for x in kv]), F.col("event_type")
        )
        return e.select(
            F.col("user_id").alias("action_id"), "event_id", F.col("ts").alias("created_at"),
            status.alias("status"), F.col("props").alias("note"), F.col("value"),
        )

    # ---- action plans, proposals and outcomes (fixed mapping, from event and action ids) --------
    # Planted defects by residue of the action id (proposals) or event id (plans, outcomes):
    # proposals 17 site -1, 19 month 13, 23 no fingerprint, 29 other source month, 31 live data,
    # 37 profit off by 1; plans 41 early start, 43 end before start, 47 early measurement,
    # 53 unknown metric, 59 target -2, 61 score guardrail 7, 67 no owner; outcomes 71 older
    # revision, 73 unknown kind, 79 window too long, 83 a metric missing.
    METRIC_TARGETS = (
        ("labour_cost_pct", 0.2), ("waste_pct", 0.1), ("operating_margin_pct", 0.3),
        ("satisfaction_score", 4.0), ("operating_profit", 1000.0), ("revenue", 50000.0),
    )

    def action_proposals(self, kpis: DataFrame) -> DataFrame:
        """One proposal per action on the December ledger of its site (site = action mod 25)."""
        a = self.t("events").groupBy(F.col("user_id").alias("action_id")).agg(F.lit(1).alias("_"))
        key = F.col("action_id")
        base = kpis.where("month = '2025-12'").drop("month").withColumnRenamed("restaurant_id", "_site")
        j = a.join(base, key % 25 == F.col("_site"), "left")
        period = F.when(key % 19 == 0, "2025-13").otherwise("2025-12")
        return j.select(
            "action_id",
            F.when(key % 17 == 0, -1).otherwise(key % 25).cast("long").alias("restaurant_id"),
            "restaurant_name", period.alias("period"),
            "revenue", "discounts", "transactions", "ingredient_cost", "waste_cost", "labour_cost", "paid_hours",
            "commission_cost", "overhead_cost", "campaign_cost",
            (F.col("operating_profit") + F.when(key % 37 == 0, 1.0).otherwise(0.0)).alias("operating_profit"),
            "labour_cost_pct", "waste_pct", "operating_margin_pct", "satisfaction_score",
            F.when(key % 23 == 0, "unknown").otherwise(F.sha2(F.concat(F.lit("ledger:"), key.cast("string")), 256)).alias("source_fingerprint"),
            F.when(key % 29 == 0, "2025-11").otherwise(period).alias("source_period"),
            F.when(key % 31 == 0, "live").otherwise("synthetic_history").alias("data_kind"),
        )

    def action_revisions(self, events: DataFrame) -> DataFrame:
        """A plan per proposal event of the sequenced ``events``."""
        e = F.col("event_id")
        start = F.date_add(F.lit("2026-01-01").cast("date"), (e % 20).cast("int"))
        start = F.when(e % 41 == 0, F.lit("2025-12-20").cast("date")).otherwise(start)
        begin = F.date_add(start, F.when(e % 47 == 0, -2).otherwise(3))
        metric, target = F.lit(None).cast("string"), F.lit(None).cast("double")
        for i, (m, t) in enumerate(self.METRIC_TARGETS):
            metric, target = F.when(e % 6 == i, m).otherwise(metric), F.when(e % 6 == i, t).otherwise(target)
        text = lambda what: F.concat(F.lit(f"{what} "), e.cast("string"))
        return events.where("status = 'proposed'").select(
            "action_id", "revision", "created_at",
            F.lit("2025-12").alias("period"),
            text("problem").alias("problem"), text("evidence").alias("evidence"), text("trial").alias("intervention"),
            F.when(e % 67 == 0, " ").otherwise(F.concat(F.lit("Owner "), (e % 7).cast("string"))).alias("owner"),
            text("against").alias("comparison_approach"), text("basis").alias("expected_impact_basis"),
            start.alias("start_date"),
            F.date_add(start, F.when(e % 43 == 0, -1).otherwise(30)).alias("end_date"),
            begin.alias("measurement_start"), F.date_add(begin, 20).alias("measurement_end"),
            F.when(e % 53 == 0, "footfall").otherwise(metric).alias("primary_metric"),
            F.when(e % 59 == 0, -2.0).otherwise(target).alias("target"),
            F.when(e % 61 == 0, 7.0).otherwise(3.5).alias("satisfaction_min"),
            F.lit(0.2).alias("late_delivery_max"),
            ((e % 5).cast("double") * -0.01).alias("hours_change"), F.lit(0.0).alias("wage_change"),
            ((e % 3).cast("double") * 0.01).alias("price_change"), F.lit(0.0).alias("demand_change"),
        )

    def action_outcomes(self, events: DataFrame, revisions: DataFrame) -> DataFrame:
        """An outcome per even-numbered in-progress event, against the revision of its time."""
        e = F.col("event_id")
        o = events.where("status = 'in progress' AND event_id % 2 = 0").withColumn("latest_revision", F.col("revision"))
        o = o.withColumn("revision", F.col("revision") - F.when(e % 71 == 0, 1).otherwise(0))
        plan = revisions.select("action_id", "revision", "primary_metric", "measurement_start", "measurement_end")
        j = o.join(plan, ["action_id", "revision"], "left")
        value = F.when(F.col("primary_metric") == "satisfaction_score", 1.0 + e % 5).otherwise((e % 100) / 100.0)
        names = F.array_distinct(F.filter(F.array(
            F.coalesce("primary_metric", F.lit("footfall")), F.lit("satisfaction_score"),
            F.when(e % 83 != 0, F.lit("late_delivery_pct")),
        ), lambda x: x.isNotNull()))
        filled = lambda n: F.when(n == "satisfaction_score", (1 + e % 5).cast("double")).when(n == "late_delivery_pct", (e % 10) / 10.0).otherwise(value)
        return j.select(
            e.alias("outcome_id"), "action_id", "revision", "latest_revision", F.col("status").alias("action_status"), "created_at",
            F.when(e % 73 == 0, "guess").when(e % 4 == 0, "simulated").otherwise("user_entered").alias("kind"),
            F.date_add("measurement_start", F.when(e % 3 == 0, 1).otherwise(0)).alias("window_start"),
            F.date_add("measurement_end", F.when(e % 79 == 0, 5).otherwise(0)).alias("window_end"),
            F.map_from_arrays(names, F.transform(names, filled)).alias("metrics"),
        )

    # ---- raw product export with planted taxonomy defects (fixed mapping) ----
    # key mod 7 = 0: category written in lower case with padding (an alias);
    # key mod 11 = 0: a valid but wrong category, rotated
    #   ECONOMY -> LARGE -> MEDIUM -> PROMO -> SMALL -> STANDARD -> ECONOMY.
    CATEGORY_ROTATION = {
        "ECONOMY": "LARGE",
        "LARGE": "MEDIUM",
        "MEDIUM": "PROMO",
        "PROMO": "SMALL",
        "SMALL": "STANDARD",
        "STANDARD": "ECONOMY",
    }

    def raw_products(self) -> DataFrame:
        p = self.products()
        rot = F.element_at(
            F.create_map(*[F.lit(x) for kv in self.CATEGORY_ROTATION.items() for x in kv]), F.col("category")
        )
        cat = (
            F.when(F.col("product_id") % 11 == 0, rot)
            .when(F.col("product_id") % 7 == 0, F.concat(F.lit("  "), F.lower("category"), F.lit(" ")))
            .otherwise(F.col("category"))
        )
        return p.withColumn("category", cat)
