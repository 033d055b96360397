"""Planning, ridge forecast, promotion identity, action-log and streaming checks."""

import datetime as dt
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsledger.operators import histogram_boosting as boosting
from opsledger.operators import actions, forecast_models, planning, promotions
from opsledger.sources.adapters import HISTORY_START

ORIGIN = "2025-09-09"


# ---------------------------------------------------------------- planning
def _shift(spark, start, end, brk=0.5, role="Service"):
    d = dt.date(2025, 1, 6)
    return spark.createDataFrame(
        [(1, d, role, dt.datetime.combine(d, start), dt.datetime.combine(d, end), brk)],
        "restaurant_id int, business_date date, role string, scheduled_start timestamp_ntz, "
        "scheduled_end timestamp_ntz, break_hours double",
    )


def test_shift_with_break_spreads_over_three_hours(spark):
    s = _shift(spark, dt.time(11), dt.time(14))
    rows = {r["hour"]: r for r in planning.scheduled_hourly(s).collect()}
    assert sorted(rows) == list(range(11, 22))
    assert sum(r["scheduled_paid_hours"] for r in rows.values()) == pytest.approx(2.5)
    for h in (11, 12, 13):
        assert rows[h]["scheduled_service_hours"] == pytest.approx(2.5 / 3, abs=1e-6)
    assert rows[14]["scheduled_paid_hours"] == 0


def test_invalid_shift_raises(spark):
    with pytest.raises(ValueError, match="end before they start"):
        planning.scheduled_hourly(_shift(spark, dt.time(14), dt.time(11)))


def test_shift_outside_trading_hours_raises(spark):
    with pytest.raises(ValueError, match="outside trading hours"):
        planning.scheduled_hourly(_shift(spark, dt.time(8), dt.time(12)))


@pytest.mark.parametrize(
    "kw", [dict(utilisation=0.2), dict(minimum_service_staff=1.5), dict(loaded_hourly_wage=0.5), dict(demand_multiplier=5)]
)
def test_planning_assumptions_are_validated(kw):
    with pytest.raises(ValueError):
        planning.PlanningAssumptions(**kw).validate()


def test_plan_hours_per_forecast_day(ctx):
    plan = planning.hourly_plan(ctx.store_day, ctx.planning_hour, ctx.forecast_daily)
    n_days = ctx.forecast_daily.count()
    assert plan.count() == n_days * 11
    bad = plan.filter(F.col("history_complete") & F.col("suggested_service_hours").isNull()).count()
    assert bad == 0


def test_plan_ignores_future_history(ctx):
    """Rows after the origin cannot change the profile (L01 reads the 84 days ending at the origin)."""
    hist = ctx.store_day
    poisoned = hist.withColumn(
        "revenue", F.when(F.col("business_date") > F.lit("2025-12-31").cast("date"), F.lit(1e9)).otherwise(F.col("revenue"))
    )
    a = planning.weekday_profile(hist, ctx.planning_hour, "2025-10-01")[0]
    b = planning.weekday_profile(poisoned, ctx.planning_hour, "2025-10-01")[0]
    assert sorted(a.collect()) == sorted(b.collect())


# ---------------------------------------------------------------- ridge
@pytest.fixture(scope="module")
def ridge(ctx):
    cal = ctx.forecast_calendar
    hist = ctx.store_day.select("restaurant_id", "business_date", "revenue")
    rows = forecast_models.feature_rows(hist, ctx.restaurants, cal, HISTORY_START)
    ids = [r[0] for r in ctx.restaurants.select("restaurant_id").orderBy("restaurant_id").collect()]
    train = rows.filter(F.col("business_date") <= F.lit(ORIGIN).cast("date"))
    fit = forecast_models.fit_ridge(train, 60.0)
    return hist, cal, ids, train, fit


def dense_design(site_ids):
    """The ridge's features with a column per site, for the dense closed form."""
    cols = {f"store_{k}": (F.col("restaurant_id") == k).cast("double") for k in site_ids}
    cols |= {f"weekday_{d}": (F.col("weekday") == d).cast("double") for d in range(7)}
    cols |= {f"weekend_store_{k}": ((F.col("restaurant_id") == k) & (F.col("weekday") >= 5)).cast("double") for k in site_ids}
    return cols | {c: F.col(c).cast("double") for c in ("annual_sin", "annual_cos", "trend_years", "holiday", *forecast_models.LAGS)}


def test_ridge_matches_closed_form(ridge):
    hist, cal, ids, train, fit = ridge
    cols = dense_design(ids)
    pdf = train.select(*[c.alias(n) for n, c in cols.items()], "revenue").toPandas()
    x = pdf[list(cols)].to_numpy(float)
    y = pdf.revenue.to_numpy(float)
    sd = x.std(0)
    sd[sd == 0] = 1
    z = (x - x.mean(0)) / sd
    zc, yc = z - z.mean(0), y - y.mean()
    w = np.linalg.solve(zc.T @ zc + 60 * np.eye(z.shape[1]), zc.T @ yc)
    raw = dict(zip(cols, w / sd))
    got = raw_weights(fit)
    assert set(got) == set(raw)
    assert np.allclose([got[k] for k in raw], list(raw.values()), rtol=1e-6, atol=1e-6 * np.abs(w / sd).max())
    assert fit.intercept == pytest.approx(y.mean() - x.mean(0) @ (w / sd), rel=1e-6)


def raw_weights(fit):
    own = {f"{name}_{r.restaurant_id}": r.weights[i] for r in fit.groups.collect() for i, name in enumerate(fit.inner)}
    return fit.common | own


def test_grouped_ridge_with_thousands_of_groups(spark):
    """More than 4096 columns in the dense design; the same closed form, by block elimination."""
    from opsledger.operators import grouped_ridge

    rng = np.random.default_rng(3)
    n_groups, rows = 2050, 4
    g = np.repeat(np.arange(n_groups), rows)
    h, c = rng.integers(0, 2, g.size).astype(float), rng.normal(size=g.size)
    y = g % 7 + 2 * h * (g % 3) + 3 * c + rng.normal(size=g.size)
    df = spark.createDataFrame(list(zip(g.tolist(), h.tolist(), c.tolist(), y.tolist())), "g long, h double, c double, y double")
    fit = grouped_ridge.fit_grouped(df, "g", {"one": F.lit(1.0), "h": F.col("h")}, {"c": F.col("c")}, {"y": F.col("y")}, 5.0)["y"]
    # the dense normal equations of the whole design
    x = np.zeros((g.size, 2 * n_groups + 1))
    x[np.arange(g.size), g], x[np.arange(g.size), n_groups + g], x[:, -1] = 1.0, h, c
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-8] = 1.0
    xc = x - mean
    w = np.linalg.solve(xc.T @ xc + 5 * np.diag(scale**2), xc.T @ (y - y.mean()))
    u, v = [y.mean() - mean @ w, w[-1]], np.c_[w[:n_groups], w[n_groups:-1]]
    assert fit.intercept == pytest.approx(u[0], abs=1e-6) and fit.common["c"] == pytest.approx(u[1], abs=1e-6)
    got = {r.g: r.weights for r in fit.groups.collect()}
    assert np.allclose([got[k] for k in range(n_groups)], v, atol=1e-6)


def test_ridge_recursion_matches_python_loop(ctx, ridge):
    hist, cal, ids, train, fit = ridge
    got = forecast_models.recursive_forecast(fit, hist, ctx.restaurants, cal, ORIGIN, HISTORY_START).toPandas()
    wts, b0 = raw_weights(fit), fit.intercept
    h = hist.toPandas().sort_values(["restaurant_id", "business_date"])
    hol = {(r["business_date"], r["state"]): r["is_public_holiday"] for r in cal.collect()}
    state_of = {r["restaurant_id"]: r["state"] for r in ctx.restaurants.collect()}
    o = dt.date.fromisoformat(ORIGIN)
    start = dt.date.fromisoformat(HISTORY_START)
    for sid in ids:
        vals = h[(h.restaurant_id == sid) & (h.business_date <= o)].revenue.tolist()
        for step in range(1, 29):
            d = o + dt.timedelta(days=step)
            wd = d.weekday()
            doy = d.timetuple().tm_yday
            x = {f"store_{s}": float(s == sid) for s in ids}
            x.update({f"weekday_{k}": float(wd == k) for k in range(7)})
            x.update({f"weekend_store_{s}": float(s == sid and wd >= 5) for s in ids})
            x.update(
                annual_sin=np.sin(2 * np.pi * doy / 365.25), annual_cos=np.cos(2 * np.pi * doy / 365.25),
                trend_years=(d - start).days / 365.25, holiday=float(hol.get((d, state_of[sid]), 0)),
                lag7=vals[-7], lag28=vals[-28], mean28=float(np.mean(vals[-28:])),
            )
            pred = max(b0 + sum(wts[k] * v for k, v in x.items()), 0.0)
            vals.append(pred)
            g = got[(got.restaurant_id == sid) & (got.horizon_day == step)].forecast_revenue.iloc[0]
            assert g == pytest.approx(pred, rel=1e-7, abs=0.0051)  # whole cents


def test_ridge_forecast_ignores_poisoned_future(ctx, ridge):
    hist, cal, ids, train, fit = ridge
    poisoned = hist.withColumn(
        "revenue", F.when(F.col("business_date") > F.lit(ORIGIN).cast("date"), F.lit(1e9)).otherwise(F.col("revenue"))
    )
    a = forecast_models.ridge_backtest(hist, ctx.restaurants, cal, [("Validation", 1, ORIGIN)], HISTORY_START)
    b = forecast_models.ridge_backtest(poisoned, ctx.restaurants, cal, [("Validation", 1, ORIGIN)], HISTORY_START)
    cols = ["restaurant_id", "business_date", "forecast_revenue"]
    assert sorted(a.select(*cols).collect()) == sorted(b.select(*cols).collect())


# ---------------------------------------------------------------- promotions
def test_contribution_identity(ctx):
    e = promotions.promotion_effectiveness(ctx.promotions, ctx.restaurants, ctx.store_day, reps=50).filter(
        F.col("incremental_contribution").isNotNull()
    )
    for r in e.collect():
        lhs = r["incremental_contribution"]
        rhs = r["incremental_revenue"] - r["incremental_variable_cost"] - r["incremental_labour_cost"] - r["campaign_cost"]
        assert lhs == pytest.approx(rhs, abs=1e-6)
        assert r["contribution_low95"] <= r["contribution_high95"]


def test_bootstrap_is_partition_independent(ctx, spark):
    e1 = promotions.promotion_effectiveness(ctx.promotions, ctx.restaurants, ctx.store_day, reps=50)
    e2 = promotions.promotion_effectiveness(
        ctx.promotions.repartition(7), ctx.restaurants, ctx.store_day.repartition(3), reps=50
    )
    cols = ["promotion_id", "contribution_low95", "contribution_high95"]
    a = {r[0]: r for r in e1.select(*cols).collect()}
    b = {r[0]: r for r in e2.select(*cols).collect()}
    assert a.keys() == b.keys()
    for k in a:
        for i in (1, 2):
            assert (a[k][i] is None and b[k][i] is None) or a[k][i] == pytest.approx(b[k][i], rel=1e-12)


# ---------------------------------------------------------------- action log
@pytest.mark.parametrize("bucket", ["minute", "hour", "day", "year"])
def test_two_level_sequence_equals_single_window(ctx, bucket):
    from pyspark.sql import Window

    ev = ctx.action_events
    w = Window.partitionBy("action_id").orderBy("created_at", "event_id")
    brute = ev.select(
        "event_id", F.row_number().over(w).alias("sequence"), F.lag("status").over(w).alias("previous_status")
    )
    got = actions.sequenced(ev, bucket=bucket).select("event_id", "sequence", "previous_status")
    assert got.exceptAll(brute).count() == 0 and brute.exceptAll(got).count() == 0


def test_transition_rules():
    assert set(actions.TRANSITIONS["completed"]) == set()
    assert "approved" in actions.TRANSITIONS["proposed"]


# ---------------------------------------------------------------- streaming
def test_stream_matches_batch_for_closed_hours(spark):
    import os
    import shutil

    from conftest import SF

    from opsledger.streaming import status_stream

    src = tempfile.mkdtemp(prefix="opsledger-stream-src-")
    shutil.copy(os.path.join(SF, "events.parquet"), os.path.join(src, "events-0.parquet"))
    sink = tempfile.mkdtemp(prefix="opsledger-stream-sink-")
    ckpt = tempfile.mkdtemp(prefix="opsledger-stream-ckpt-")
    q = status_stream.start(spark, src, sink, checkpoint=ckpt, available_now=True)
    q.awaitTermination(300)
    got = spark.read.parquet(sink)
    batch = status_stream.hourly_status_counts(spark.read.parquet(os.path.join(src, "events-0.parquet")))
    n = got.count()
    assert n > 0
    closed = batch.join(got.select("window_start").distinct(), "window_start")
    assert got.exceptAll(closed.select(*got.columns)).count() == 0
    assert closed.count() == n


# ---------------------------------------------------------------- diagnostics models
def test_site_bootstrap_equals_replicated_rows(ctx):
    from opsledger.operators import diagnostics_models as dm

    res = dm.residualised(dm.association_sample(ctx.store_day, min_surveys=1))
    boot = {r["rep"]: r["correlation"] for r in dm.site_bootstrap(res, reps=5).collect()}
    pdf = res.toPandas()
    sites = sorted(pdf.restaurant_id.unique())
    import hashlib

    for rep in range(5):
        picks = [int(hashlib.md5(f"{rep}|{pos}|42".encode()).hexdigest()[:8], 16) % len(sites) for pos in range(len(sites))]
        rows = np.concatenate([pdf[pdf.restaurant_id == sites[i]][["x_res", "y_res"]].to_numpy() for i in picks])
        assert boot[rep] == pytest.approx(np.corrcoef(rows[:, 0], rows[:, 1])[0, 1], rel=1e-6, abs=1e-9)


def test_residual_ridge_matches_closed_form(ctx):
    from opsledger.operators import diagnostics_models as dm

    sample = dm.association_sample(ctx.store_day, min_surveys=1)
    res = dm.residualised(sample).toPandas().sort_values(["restaurant_id", "business_date"])
    s = sample.toPandas().sort_values(["restaurant_id", "business_date"])
    import pandas as pd

    x = pd.get_dummies(s[["restaurant_id", "weekday", "month"]].astype(str), dtype=float)
    x["log_orders"] = np.log1p(s.transactions.to_numpy(float))
    xm = x.to_numpy()
    xc = xm - xm.mean(0)
    for target, col in (("service_pressure", "x_res"), ("satisfaction_score", "y_res")):
        y = s[target].to_numpy(float)
        w = np.linalg.solve(xc.T @ xc + 1.0 * np.eye(xc.shape[1]), xc.T @ (y - y.mean()))
        pred = xc @ w + y.mean()
        assert np.allclose(res[col].to_numpy(), y - pred, atol=1e-6)


def test_segments_cover_every_site_with_three_names(ctx):
    from opsledger.operators import diagnostics_models as dm
    from opsledger.operators import kpi

    seg = dm.site_segments(kpi.store_totals(ctx.store_day, ctx.restaurants), n_init=3).toPandas()
    assert len(seg) == ctx.restaurants.count()
    assert set(seg.store_segment) == set(dm.SEGMENT_NAMES)
    m = seg.groupby("store_segment").operating_margin_pct.mean()
    assert m["Needs support"] <= m["Stable"] <= m["Efficient"]


def test_gbt_forecast_ignores_poisoned_future(ctx):
    hist = ctx.store_day.select("restaurant_id", "business_date", "revenue")
    poisoned = hist.withColumn(
        "revenue", F.when(F.col("business_date") > F.lit(ORIGIN).cast("date"), F.lit(1e9)).otherwise(F.col("revenue"))
    )
    cal = ctx.forecast_calendar
    o = [("Validation", 1, ORIGIN)]
    p = boosting.Params(iterations=12)
    a = forecast_models.gbt_backtest(hist, ctx.restaurants, cal, o, HISTORY_START, horizon=7, params=p)
    b = forecast_models.gbt_backtest(poisoned, ctx.restaurants, cal, o, HISTORY_START, horizon=7, params=p)
    cols = ["restaurant_id", "business_date", "forecast_revenue"]
    ra, rb = sorted(a.select(*cols).collect()), sorted(b.select(*cols).collect())
    assert len(ra) == ctx.restaurants.count() * 7
    assert ra == rb
    assert min(r["forecast_revenue"] for r in ra) >= 0


# ---------------------------------------------------------------- append-only log, bundle metadata and gate
def test_append_only_event_log_is_idempotent(ctx):
    path = tempfile.mkdtemp(prefix="opsledger-events-") + "/log"
    ev = ctx.action_events
    n = ev.count()
    assert actions.append_events(ev, path) == n
    assert actions.append_events(ev, path) == 0  # a retried append adds nothing
    assert actions.read_events(ctx.spark, path, ev.schema).count() == n


def test_stored_marts_carry_their_dictionary(ctx, spark):
    from opsledger.operators import catalog

    mart = ctx.stored("described_store_month", lambda: catalog.described("store_month_kpis", ctx.store_month_kpis))
    again = spark.read.parquet(*{f.rsplit("/", 1)[0] for f in mart.inputFiles()})  # a reader that knows only the files
    rows = {r.field: r for r in catalog.schema_dictionary(spark, {"store_month_kpis": again}).collect()}
    assert set(rows) == set(ctx.store_month_kpis.columns) and all(r.definition for r in rows.values())
    assert {c for c, r in rows.items() if r.is_pk} == {"restaurant_id", "month"}
    g = catalog.grain_catalog({"store_month_kpis": again, "twice": again.unionByName(again)}).collect()
    assert [r.repeated_keys for r in g] == [0, again.count()] and g[0].rows == again.count()
    assert g[0].grain_keys == "restaurant_id, month" and "targets" in g[0].lineage
    with pytest.raises(KeyError):
        catalog.described("store_month_kpis", ctx.store_month_kpis.withColumn("unheard_of", F.lit(1)))


def test_bundle_gate_passes_and_fails(ctx, spark):
    from opsledger.operators import bundle
    from opsledger.plans import registry

    from conftest import SF

    registry.load_all()
    checks = registry.QUERIES["q17_bundle_checks"](spark, SF)
    bundle.raise_on_fail(checks)  # every check passes on the built marts
    dup = ctx.store_day.unionByName(ctx.store_day.limit(1))
    bad = bundle.key_checks("store_day", dup, bundle.KEYS["store_day"], ctx.restaurants.select("restaurant_id"))
    with pytest.raises(ValueError, match="store_day"):
        bundle.raise_on_fail(bad)


# ---------------------------------------------------------------- sources and sinks
def test_csv_gzip_and_json_round_trip(ctx, spark):
    import os

    from pyspark.sql.types import DateType, DoubleType, LongType, StructField, StructType

    from opsledger.sources import tables

    df = ctx.store_day.select("restaurant_id", "business_date", "revenue", "overhead_cost").limit(50)
    df = df.withColumn("overhead_cost", F.when(F.col("restaurant_id") % 2 == 0, F.lit(None)).otherwise(F.col("overhead_cost")))
    schema = StructType([
        StructField("restaurant_id", LongType()), StructField("business_date", DateType()),
        StructField("revenue", DoubleType()), StructField("overhead_cost", DoubleType()),
    ])
    base = tempfile.mkdtemp(prefix="opsledger-io-")
    tables.write_csv(df, os.path.join(base, "plain.csv"))
    tables.write_csv(df, os.path.join(base, "packed.csv.gz"), gzip=True)
    want = sorted((r[0], r[1], round(r[2], 8), None if r[3] is None else round(r[3], 8)) for r in df.collect())
    for name in ("plain", "packed"):
        back = tables.read_csv(spark, base, name, schema).collect()
        got = sorted((r[0], r[1], r[2], r[3]) for r in back)
        assert got == want  # empty fields come back null, never 0
    tables.write_json(df, os.path.join(base, "rows.json"))
    assert spark.read.json(os.path.join(base, "rows.json")).count() == df.count()


def test_stateful_audit_stream_equals_batch_across_batches(ctx, spark):
    import os

    import pyarrow.parquet as pq

    from conftest import SF

    from opsledger.streaming import action_state

    t = pq.read_table(os.path.join(SF, "events.parquet")).to_pandas()
    cut = t.ts.sort_values().iloc[len(t) // 2]
    src = tempfile.mkdtemp(prefix="opsledger-state-src-")
    t[t.ts < cut].to_parquet(os.path.join(src, "events-0.parquet"), index=False)
    t[t.ts >= cut].to_parquet(os.path.join(src, "events-1.parquet"), index=False)
    q = action_state.start_audit(spark, src, "audit_state_test", checkpoint=tempfile.mkdtemp(prefix="opsledger-state-ckpt-"))
    q.awaitTermination(300)
    got = spark.sql("SELECT action_id, max_by(struct(events, violations, current_status), events) AS s "
                    "FROM audit_state_test GROUP BY action_id").select("action_id", "s.*")
    want = actions.violation_summary(actions.transition_audit(ctx.action_events)).join(
        actions.current_state(ctx.action_events).select("action_id", "current_status"), "action_id"
    )
    cols = ["action_id", "events", "violations", "current_status"]
    assert sorted(got.select(*cols).collect()) == sorted(want.select(*cols).collect())


def test_shift_outside_trading_hours_allocates_nothing(spark):
    from opsledger.operators import marts

    s = _shift(spark, dt.time(22), dt.time(23), brk=0.0)
    dur = F.timestamp_diff("SECOND", F.col("scheduled_start"), F.col("scheduled_end")) / 3600.0
    rows = marts.allocate_hours(s, "scheduled_start", "scheduled_end", dur).collect()
    assert all(r["paid_alloc"] == 0 for r in rows) and all(11 <= r["hour"] <= 21 for r in rows)


def test_association_on_empty_sample_is_null_not_error(ctx):
    from opsledger.operators import diagnostics_models as dm

    empty = ctx.store_day.filter(F.lit(False))
    r = dm.staffing_association(empty).collect()
    assert len(r) == 1 and r[0]["store_days"] == 0 and r[0]["controlled_correlation"] is None
    assert dm.site_bootstrap(dm.residualised(dm.association_sample(empty)), reps=3).count() == 0


def test_winner_forecast_and_findings_shape(ctx, spark):
    from opsledger.plans import registry

    from conftest import SF

    registry.load_all()
    f = registry.QUERIES["f10_winner_forecast"](spark, SF).toPandas()
    assert len(f) == ctx.restaurants.count() * 28
    assert (f.forecast_revenue >= 0).all() and (f.lower_80.dropna() >= 0).all()
    assert f.model.nunique() == 1
    x = registry.QUERIES["x10_findings"](spark, SF).toPandas()
    assert sorted(x.finding) == list(range(1, 9))
    assert x.title.notna().all() and set(x.priority) <= {"High", "Medium"}


def test_source_manifest_matches_file_hashes(ctx, spark):
    import hashlib
    import os

    from conftest import SF

    from opsledger.operators import bundle

    rows = bundle.source_manifest(spark, SF, ["region", "nation", "events"]).collect()
    assert {r["table"] for r in rows} == {"region", "nation", "events"}
    for r in rows:
        path = os.path.join(SF, f"{r['table']}.parquet")
        data = open(path, "rb").read()
        assert r["bytes"] == len(data)
        assert r["sha256"] == hashlib.sha256(data).hexdigest()


def test_strict_plan_raises_exactly_when_history_is_incomplete(ctx):
    plan = planning.hourly_plan(ctx.store_day, ctx.planning_hour, ctx.forecast_daily)
    incomplete = plan.filter(~F.col("history_complete")).count()
    if incomplete:
        with pytest.raises(ValueError, match="no basket value"):
            planning.hourly_plan(ctx.store_day, ctx.planning_hour, ctx.forecast_daily, strict=True)
    else:
        assert planning.hourly_plan(ctx.store_day, ctx.planning_hour, ctx.forecast_daily, strict=True).count() == plan.count()


def test_forecasts_from_two_origins_are_rejected(ctx):
    two = ctx.forecast_daily.unionByName(
        ctx.forecast_daily.withColumn("origin_date", F.date_sub("origin_date", 1))
    )
    with pytest.raises(ValueError, match="one origin"):
        planning.check_forecasts(two)
