"""Join guards, write contracts, concurrent appends, bitmaps, dense index, the chosen model."""

import tempfile
import threading

import pytest
from pyspark.sql import functions as F

from opsledger.functions.indexing import dense_index
from opsledger.functions.semantics import unique_on
from opsledger.operators import actions, forecast, kpi, marts, promotions
from opsledger.plans import context


# ---------------------------------------------------------------- J01, Q02, Q19
def test_repeated_key_fails_the_job_that_reads_it(spark):
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k int, v string")
    facts = spark.createDataFrame([(1,)], "k int")
    assert sorted(facts.join(unique_on(dim.where("v <> 'c'"), "k"), "k").collect()) == [(1, "a")]
    for join in (facts.join(unique_on(dim, "k"), "k"), facts.join(F.broadcast(unique_on(dim, ["k"])), "k", "left")):
        with pytest.raises(Exception, match="not unique"):
            join.collect()


@pytest.mark.parametrize("which", ["restaurants", "calendar", "products", "targets"])
def test_repeated_dimension_stops_the_build(ctx, which):
    dim = getattr(ctx, which)
    twice = dim.unionByName(dim.limit(1))
    build = {
        "restaurants": lambda: marts.spine(twice, ctx.calendar),
        "calendar": lambda: marts.spine(ctx.restaurants, twice),
        "products": lambda: marts.product_month(ctx.transactions, twice),
        "targets": lambda: kpi.store_month_kpis(ctx.store_day, twice, ctx.restaurants),
    }[which]
    with pytest.raises(Exception, match="not unique"):
        build().write.format("noop").mode("overwrite").save()


def test_breach_stops_the_mart_before_it_has_a_name(ctx, monkeypatch):
    monkeypatch.setitem(context.CONTRACTS, "broken_mart", {"value is known": "v IS NULL", "value is small": "v > 3"})
    rows = ctx.spark.createDataFrame([(1,), (5,), (None,), (7,)], "v int")
    with pytest.raises(ValueError, match=r"value is known \(1 rows\), value is small \(3 rows\)"):
        ctx.stored("broken_mart", lambda: rows)
    fs, path = context._hadoop(ctx.spark, f"{context.checkpoint_dir(ctx.spark).rstrip('/')}/opsledger-marts/{ctx.fingerprint}/broken_mart")
    assert not fs.exists(path)
    assert ctx.stored("broken_mart", lambda: rows.where("v = 1")).count() == 1  # mended: the name is free


def test_month_without_target_stays(ctx):
    some = ctx.targets.where("month <> '2025-03'")
    out = kpi.store_month_kpis(ctx.store_day, some, ctx.restaurants)
    march = out.where("month = '2025-03'").collect()
    assert len(march) == ctx.restaurants.count()
    assert all(r.revenue_target is None and r.performance_index is None and not r.index_complete for r in march)
    assert out.count() == ctx.store_month_kpis.count()


# ---------------------------------------------------------------- E01
def test_two_writers_add_each_event_once(ctx, monkeypatch):
    spark = ctx.spark
    path = tempfile.mkdtemp(prefix="opsledger-events-") + "/log"
    ev = ctx.action_events
    first, second = ev.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) < 2), ev.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) > 0)
    meet, commit, lost = threading.Barrier(2), actions._commit, []

    def together(*args):
        if args[2] == 1:
            meet.wait(60)  # both have checked against version 0
        won = commit(*args)
        if not won:
            lost.append(args)
        return won

    monkeypatch.setattr(actions, "_commit", together)
    added = {}
    writers = [threading.Thread(target=lambda n=n, d=d: added.setdefault(n, actions.append_events(d, path))) for n, d in (("a", first), ("b", second))]
    for w in writers:
        w.start()
    for w in writers:
        w.join(300)
    assert len(lost) == 1
    log = actions.read_events(spark, path, ev.schema)
    assert log.count() == log.select("event_id").distinct().count() == ev.count() == sum(added.values())
    assert actions.log_version(spark, path)[0] == 2
    assert actions.append_events(ev, path) == 0 and actions.log_version(spark, path)[0] == 2


def test_uncommitted_files_are_not_read(ctx):
    path = tempfile.mkdtemp(prefix="opsledger-events-") + "/log"
    ev = ctx.action_events
    ev.withColumn("event_date", F.to_date("created_at")).write.partitionBy("event_date").parquet(f"{path}/data/append=lost")
    assert actions.read_events(ctx.spark, path, ev.schema).count() == 0
    assert actions.append_events(ev, path) == ev.count() == actions.read_events(ctx.spark, path, ev.schema).count()


# ---------------------------------------------------------------- M01, D04
def test_controls_in_a_group_of_many_words(spark):
    """300 peers are five words of the bitmap; every pair of intervals is tried in plain Python."""
    import datetime as dt
    import random

    rnd = random.Random(4)
    sites = [(k, "G" if k < 300 else f"H{k % 2}") for k in range(310)]
    camps = []
    for n, k in enumerate(rnd.sample(range(310), 90)):
        start = dt.date(2025, 1, 1) + dt.timedelta(rnd.randint(0, 200))
        camps.append((f"P{n}", k, "c", start, start + dt.timedelta(rnd.randint(0, 20)), 0.1, 5.0))
    restaurants = spark.createDataFrame(sites, "restaurant_id int, location_type string")
    table = spark.createDataFrame(camps, "promotion_id string, restaurant_id int, campaign_name string, start_date date, end_date date, discount_rate double, campaign_cost double")
    got = {r.promotion_id: (r.control_stores, r.control_restaurant_ids) for r in promotions.control_selection(table, restaurants).collect()}
    kind = dict(sites)
    for p, site, _, start, end, _, _ in camps:
        dirty = {k for _, k, _, s, e, _, _ in camps if s <= end and e >= start - dt.timedelta(14)}
        want = [k for k in kind if kind[k] == kind[site] and k != site and k not in dirty]
        assert got[p] == (len(want), "[" + ", ".join(map(str, want)) + "]")


def test_dense_index_is_the_rank_on_any_partitioning(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 10007).alias("k"))
    want = {k: i for i, k in enumerate(sorted(r.k for r in df.collect()))}
    for n in (1, 7):
        out, total = dense_index(df.repartition(n), "k", "place")
        assert total == 1000 and {r.k: r.place for r in out.collect()} == want
    assert dense_index(df.limit(0), "k", "place")[1] == 0


# ---------------------------------------------------------------- F08, F10
def test_plan_follows_the_named_model(ctx):
    finals = ctx._final_forecasts()
    for name in ("Seasonal naive", "Calendar ridge"):
        winner = ctx.spark.createDataFrame([(name,)], "winner string")
        assert {r.model for r in forecast.chosen(finals, winner).select("model").distinct().collect()} == {name}
    best = ctx.winner.first().winner
    assert {r.model for r in ctx.forecast_daily.select("model").distinct().collect()} == {best}
    mae = forecast.metrics(ctx.model_traces().where("evaluation_period = 'Validation'"), ["model", "fold"]).groupBy("model").agg(F.avg("mae").alias("m")).collect()
    assert best == min(mae, key=lambda r: (r.m, r.model)).model
