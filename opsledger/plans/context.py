"""Lazy bundle of canonical facts and marts for one input folder.

Every attribute is a lazy DataFrame; nothing is computed until an action.
Catalyst prunes the columns each consumer does not need, so a query that only
reads ``store_day.revenue`` never scans the labour or waste inputs' unused
columns.
"""

from __future__ import annotations

import hashlib
import uuid
from datetime import date, timedelta
from functools import cache, cached_property
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.semantics import estimated_bytes
from ..operators import kpi, marts, quality
from ..session import checkpoint_dir, configure, size_shuffles
from ..sources.adapters import HISTORY_END, HISTORY_START, Source
from ..sources.tables import DRIVER_TABLES

_STORED: dict[tuple[str, str], str] = {}
_HOLDS: set[tuple[str, str]] = set()


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of a path in whatever store holds it."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath


@cache
def _code_version() -> str:
    """Hash of the modules whose code decides what a mart holds."""
    h = hashlib.sha256()
    root = Path(__file__).resolve().parents[1]
    for part in ("functions", "operators", "sources", "plans/context.py"):
        for f in sorted([root / part] if part.endswith(".py") else (root / part).glob("*.py")):
            h.update(f.name.encode() + f.read_bytes())
    return h.hexdigest()


def fingerprint(spark: SparkSession, folder: str) -> str:
    """Identity of the inputs and of the code: every leaf file's path, size and time.

    The listing goes through the file system of the folder itself, so a rewritten part file
    is noticed in any store.
    """
    h = hashlib.sha256(_code_version().encode())
    for table in DRIVER_TABLES:
        fs, path = _hadoop(spark, f"{folder.rstrip('/')}/{table}.parquet")
        if not fs.exists(path):
            continue
        files, found = fs.listFiles(path, True), []
        while files.hasNext():
            f = files.next()
            found.append(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}")
        h.update("\n".join([table, *sorted(found)]).encode())
    return h.hexdigest()[:16]


_KEY_DAY = {"key is populated": "restaurant_id IS NULL OR business_date IS NULL"}
#: What no row of a stored mart may be; unknown counts as a breach.
CONTRACTS: dict[str, dict[str, str]] = {
    "transactions": {
        "line and order are populated": "transaction_line_id IS NULL OR order_id IS NULL OR restaurant_id IS NULL",
        "amounts are finite": "NOT (net_revenue >= 0 AND net_revenue < double('inf') AND list_revenue >= net_revenue - 0.011)",
        "day is known": "business_date IS NULL",
    },
    "labour": {"shift has hours and a rate": "NOT (paid_hours BETWEEN 0 AND 16 AND hourly_cost >= 0)"},
    "orders": {"key is populated": "order_id IS NULL OR restaurant_id IS NULL", "order has a day": "business_date IS NULL"},
    "store_day": _KEY_DAY
    | {
        "ledger adds up": "abs(revenue - ingredient_cost - waste_cost - labour_cost - commission_cost - coalesce(overhead_cost, 0) - campaign_cost - operating_profit) > 0.01",
        "counts are not negative": "transactions < 0 OR deliveries < late_deliveries OR survey_responses < 0",
    },
    "store_hour": _KEY_DAY | {"hour is a trading hour": "hour IS NULL OR hour NOT BETWEEN 11 AND 21"},
    "store_month_kpis": {"key is populated": "restaurant_id IS NULL OR month IS NULL", "index lies in 0 to 100": "performance_index IS NOT NULL AND performance_index NOT BETWEEN 0 AND 100"},
    "forecast_daily": _KEY_DAY | {"band holds the forecast": "forecast_revenue IS NULL OR NOT (lower_80 <= forecast_revenue AND forecast_revenue <= upper_80)"},
}


def _breaches(name: str) -> list[Column]:
    """Rows that break each rule of the mart's contract."""
    return [F.count_if(F.coalesce(F.expr(rule), F.lit(True))).alias(what) for what, rule in CONTRACTS[name].items()]


def _require_contract(name: str, counts: dict[str, int]) -> None:
    broken = {what: n for what, n in counts.items() if n}
    if broken:
        raise ValueError(f"mart {name} breaks its contract: " + ", ".join(f"{what} ({n} rows)" for what, n in broken.items()))


class Context:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder
        self.src = Source(spark, folder)
        size_shuffles(spark, estimated_bytes(self.src.t("lineitem")))
        self.src.order_sites_source = lambda: self.stored("order_sites", self.src.build_order_sites)

    # ---- canonical clean facts -----------------------------------------
    @cached_property
    def restaurants(self) -> DataFrame:
        return self.src.restaurants()

    @cached_property
    def products(self) -> DataFrame:
        return self.src.products()

    @cached_property
    def calendar(self) -> DataFrame:
        return self.src.calendar(HISTORY_START, HISTORY_END)

    @cached_property
    def transactions(self) -> DataFrame:
        """Clean order lines: complete orders without a bad line, master names, parsed times."""
        return self.checked("transactions", self._clean_transactions)

    def _clean_transactions(self) -> DataFrame:
        if not self.known_to_hold("transactions"):
            quality.require_known_sites(self.flagged, self.restaurants, "transactions")
        clean, _ = quality.quarantine_orders(self.flagged)
        return quality.finish_clean_lines(clean, self.restaurants)

    @cached_property
    def labour(self) -> DataFrame:
        return self.stored("labour", self._clean_labour)

    def _clean_labour(self) -> DataFrame:
        quality.require_known_sites(self.raw_labour, self.restaurants, "labour")
        quality.require_recoverable_shifts(self.raw_labour)
        repaired = quality.repair_labour(self.raw_labour, self.restaurants, self.calendar)
        quality.require_rates(repaired)
        return repaired.drop("hours_repaired")

    @cached_property
    def waste(self) -> DataFrame:
        return quality.split_negative_waste(self.raw_waste)[0]

    @cached_property
    def customer_feedback(self) -> DataFrame:
        repaired = quality.repair_surveys(self.raw_customer_feedback, self.orders)
        return repaired.drop("score_repaired", "order_link_removed")

    @cached_property
    def delivery(self) -> DataFrame:
        return quality.cascade_lost_orders(self.raw_delivery, self.orders)[0]

    @cached_property
    def loyalty(self) -> DataFrame:
        return quality.cascade_lost_orders(self.raw_loyalty, self.orders)[0]

    @cached_property
    def promotions(self) -> DataFrame:
        return self.src.promotions()

    @cached_property
    def targets(self) -> DataFrame:
        return self.src.targets()

    @cached_property
    def operating_costs(self) -> DataFrame:
        return self.src.operating_costs()

    @cached_property
    def facts(self) -> marts.Facts:
        return marts.Facts(
            restaurants=self.restaurants,
            calendar=self.calendar,
            transactions=self.transactions,
            labour=self.labour,
            waste=self.waste,
            customer_feedback=self.customer_feedback,
            delivery=self.delivery,
            operating_costs=self.operating_costs,
            promotions=self.promotions,
            products=self.products,
            targets=self.targets,
            loyalty=self.loyalty,
        )

    # ---- raw exports and the cleaning flow -----------------------------
    @cached_property
    def sales_lines(self) -> DataFrame:
        """Order lines before the export defects are planted (shaping of the driver tables)."""
        return self.src.shaped(self.stored("sale_rows", self.src.sale_rows))

    @cached_property
    def raw_transactions(self) -> DataFrame:
        return self.src.raw_transactions(self.sales_lines)

    @cached_property
    def raw_labour(self) -> DataFrame:
        return self.src.labour(raw=True)

    @cached_property
    def raw_customer_feedback(self) -> DataFrame:
        return self.src.customer_feedback(raw=True)

    @cached_property
    def raw_waste(self) -> DataFrame:
        return self.src.waste(raw=True, clean=self.sales_lines)

    @cached_property
    def raw_delivery(self) -> DataFrame:
        return self.src.delivery()

    @cached_property
    def raw_loyalty(self) -> DataFrame:
        return self.src.loyalty()

    # the driver data has up to 50 units per line, so that bound is a parameter
    line_rules = quality.LineRules(max_quantity=50)
    rule_names = quality.RULE_NAMES

    @cached_property
    def flagged(self) -> DataFrame:
        """Raw lines without exact repeats, with a column per rule and their order's verdict, computed once.

        Repeats, rules and verdict share one shuffle, by order."""

        def build() -> DataFrame:
            lines = quality.by_order(self.raw_transactions).dropDuplicates()
            return quality.mark_orders(quality.line_rules(lines, self.products, self.line_rules, sold=self.raw_transactions)[0])

        return self.stored("flagged", build)

    # ---- marts -----------------------------------------------------------
    @cached_property
    def orders(self) -> DataFrame:
        return self.stored("orders", lambda: marts.orders(self.transactions))

    @cached_property
    def product_month(self) -> DataFrame:
        return marts.product_month(self.transactions, self.products)

    @cached_property
    def store_day(self) -> DataFrame:
        return self.stored("store_day", lambda: marts.store_day(self.facts, self.orders))

    @cached_property
    def store_hour(self) -> DataFrame:
        return self.stored("store_hour", lambda: marts.store_hour(self.store_day, self.orders, self.labour))

    @cached_property
    def store_month_kpis(self) -> DataFrame:
        return self.stored(
            "store_month_kpis", lambda: kpi.store_month_kpis(self.store_day, self.targets, self.restaurants)
        )

    @cached_property
    def forecast_calendar(self) -> DataFrame:
        """Calendar through the last forecast day (history end + 28 days)."""
        end = (date.fromisoformat(HISTORY_END) + timedelta(days=28)).isoformat()
        return self.src.calendar(HISTORY_START, end)

    @cached_property
    def action_events(self) -> DataFrame:
        return self.src.action_events()

    @cached_property
    def sequenced_events(self) -> DataFrame:
        from ..operators import actions

        return self.stored("sequenced_events", lambda: actions.sequenced(self.action_events))

    @cached_property
    def action_proposals(self) -> DataFrame:
        return self.src.action_proposals(self.store_month_kpis)

    @cached_property
    def action_revisions(self) -> DataFrame:
        return self.src.action_revisions(self.sequenced_events)

    @cached_property
    def action_outcomes(self) -> DataFrame:
        return self.src.action_outcomes(self.sequenced_events, self.action_revisions)

    @cached_property
    def scheduled_hour(self) -> DataFrame:
        from ..operators import planning

        return self.stored("scheduled_hour", lambda: planning.scheduled_hourly(self.labour))

    @cached_property
    def planning_hour(self) -> DataFrame:
        from ..operators import planning

        return planning.planning_hours(self.store_hour, self.scheduled_hour)

    @cached_property
    def forecast_traces(self) -> DataFrame:
        from ..operators import forecast

        hist = self.store_day.select("restaurant_id", "business_date", "revenue")
        return forecast.backtest(hist, self.restaurants.select("restaurant_id"), HISTORY_END)

    @cached_property
    def revenue_history(self) -> DataFrame:
        return self.store_day.select("restaurant_id", "business_date", "revenue")

    @cached_property
    def forecast_features(self) -> DataFrame:
        from ..operators import forecast_models

        return self.stored(
            "forecast_features",
            lambda: forecast_models.feature_rows(self.revenue_history, self.restaurants, self.calendar, HISTORY_START),
        )

    @cached_property
    def origins(self) -> list[tuple[str, int, str]]:
        """(period, fold, origin) of the validation folds and the holdout."""
        from ..operators import forecast

        last = date.fromisoformat(HISTORY_END)
        return [(p, k, str(last - timedelta(days=back))) for p, k, back in forecast.folds(HISTORY_END)]

    @cached_property
    def ridge_traces(self) -> DataFrame:
        """Traces of the ridge's four fits, written once."""
        from ..operators import forecast_models

        return self.stored(
            "ridge_traces",
            lambda: forecast_models.ridge_backtest(
                self.revenue_history, self.restaurants, self.forecast_calendar, self.origins, HISTORY_START, rows=self.forecast_features
            ),
        )

    @cached_property
    def boosted_traces(self) -> DataFrame:
        """Traces of the boosted challenger, written once (the fit is some hundred passes)."""
        from ..operators import forecast_models

        return self.stored(
            "boosted_traces",
            lambda: forecast_models.gbt_backtest(
                self.revenue_history, self.restaurants, self.forecast_calendar, self.origins, HISTORY_START, rows=self.forecast_features
            ),
        )

    def model_traces(self, boosted: bool = False) -> DataFrame:
        """Stored traces of the candidates among which a model is chosen."""
        cols = ["restaurant_id", "business_date", "horizon_day", "forecast_revenue", "model", "origin_date", "evaluation_period", "fold", "actual_revenue"]
        out = self.forecast_traces.select(*cols).unionByName(self.ridge_traces.select(*cols))
        return out.unionByName(self.boosted_traces.select(*cols)) if boosted else out

    @cached_property
    def winner(self) -> DataFrame:
        """One row: the candidate with the lowest mean validation error."""
        from ..operators import forecast

        return forecast.select_winner(forecast.metrics(self.model_traces(), ["evaluation_period", "fold", "model"]))

    def _final_forecasts(self) -> DataFrame:
        """Every candidate's refit from the last history date."""
        from ..operators import forecast, forecast_models

        naive = forecast.naive_forecasts(self.revenue_history, self.restaurants.select("restaurant_id"), [("Future", 0, HISTORY_END)])
        fit = forecast_models.fit_ridge(self.forecast_features)
        ridge = forecast_models.recursive_forecast(fit, self.revenue_history, self.restaurants, self.forecast_calendar, HISTORY_END, HISTORY_START)
        cols = ["restaurant_id", "business_date", "origin_date", "forecast_revenue", "model"]
        return naive.select(*cols).unionByName(ridge.select(*cols))

    @cached_property
    def forecast_daily(self) -> DataFrame:
        """The chosen model's forecast from the last history date, with its own empirical bands.

        The choice is a semi join of the stored traces and refits on the winner: the plan that
        follows it has no branch on the driver."""
        from ..operators import forecast

        def build() -> DataFrame:
            bands = forecast.error_bands(forecast.chosen(self.model_traces(), self.winner))
            return forecast.with_bands(forecast.chosen(self._final_forecasts(), self.winner), bands)

        return self.stored("forecast_daily", build)

    # ---- materialised marts ---------------------------------------------
    def stored(self, name: str, build) -> DataFrame:
        """Write ``build()`` once as Parquet under the cluster checkpoint folder
        and read it back.

        Breaches of the mart's contract (:data:`CONTRACTS`) are counted while it is written; one is
        enough to delete what was written and raise before the folder gets its name (Q02, Q19).

        The clean facts and daily marts feed most queries; storing them cuts the
        lineage (a lost executor recomputes from durable files, not from the raw
        scans) and keeps every downstream plan small.  The folder comes from
        ``spark.checkpoint.dir`` (a scratch folder only when unset, as in tests).
        """
        key = (self.fingerprint, name)
        path = _STORED.get(key)
        if path is None:
            path = f"{checkpoint_dir(self.spark).rstrip('/')}/opsledger-marts/{key[0]}/{name}"
            fs, done = _hadoop(self.spark, f"{path}/_SUCCESS")
            if not fs.exists(done):
                # each job writes a folder of its own; the first to rename it wins
                own = f"{path}.{uuid.uuid4().hex}"
                self._write(name, build(), own)
                if not fs.rename(_hadoop(self.spark, own)[1], _hadoop(self.spark, path)[1]) or not fs.exists(done):
                    path = own
            _STORED[key] = path
        return self.spark.read.parquet(path)

    def _write(self, name: str, df: DataFrame, path: str) -> None:
        seen = Observation() if name in CONTRACTS else None
        if seen:
            df = df.observe(seen, *_breaches(name))
        df.write.option("compression", "zstd").parquet(path)
        try:
            # a task that ran twice may count twice, but none that finds nothing counts at all
            _require_contract(name, seen.get if seen else {})
        except ValueError:
            fs, own = _hadoop(self.spark, path)
            fs.delete(own, True)
            raise

    def known_to_hold(self, name: str) -> bool:
        """Whether the contract of a table that is not stored has been counted for these inputs."""
        return (self.fingerprint, name) in _HOLDS

    def checked(self, name: str, build) -> DataFrame:
        """``build()``, a cheap view of a stored table that is not worth a second copy; breaches of its
        contract are counted in one pass before its first use."""
        df = build()
        if not self.known_to_hold(name):
            _require_contract(name, df.agg(*_breaches(name)).first().asDict())
            _HOLDS.add((self.fingerprint, name))
        return df

    @cached_property
    def fingerprint(self) -> str:
        return fingerprint(self.spark, self.folder)

    def views(self, names: list[str]) -> None:
        """Register canonical tables / marts as temp views for SQL text."""
        for n in names:
            getattr(self, n).createOrReplaceTempView(n)
