"""Steps that must not move their rows more often than needed: shuffles, rows per key, bytes to the driver."""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import functions as F

from opsledger.operators import bundle, quality
from opsledger.plans.context import Context
from opsledger.sources import blocks

from conftest import SF


def test_repeats_rules_and_verdicts_share_one_shuffle(spark):
    ctx = Context(spark, SF)
    lines = quality.by_order(ctx.raw_transactions).dropDuplicates()
    rules = quality.line_rules(lines, ctx.products, ctx.line_rules, sold=ctx.raw_transactions)[0]
    marked = quality.mark_orders(rules)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = marked._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan
    # the same lines as the plain steps
    plain = quality.line_rules(ctx.raw_transactions.dropDuplicates(), ctx.products, ctx.line_rules)[0]
    bad = plain.where("_invalid AND order_id IS NOT NULL").select("order_id").distinct()
    kept = plain.where("order_id IS NOT NULL").join(bad, "order_id", "left_anti")
    got = marked.where("NOT _rejected").drop("_rejected").select(*plain.columns)
    assert got.exceptAll(kept.select(*plain.columns)).isEmpty() and kept.select(*plain.columns).exceptAll(got).isEmpty()
    assert marked.count() == plain.count()


def test_unknown_and_missing_products_break_their_rule(spark):
    ctx = Context(spark, SF)
    few = ctx.raw_transactions.where("order_id = 1 OR order_id = 2")
    some = few.where("product_id IS NOT NULL").agg(F.min("product_id")).first()[0]
    flagged = quality.line_rules(few, ctx.products.where(F.col("product_id") != some))[0]
    wrong = F.col("product_id").isNull() | (F.col("product_id") == some)
    assert flagged.where(F.col("_r1") != wrong).count() == 0 and flagged.where(wrong).count() > 0
    assert flagged.count() == few.count()


def test_clean_lines_are_a_view_and_still_checked(spark, monkeypatch):
    from opsledger.plans import context

    monkeypatch.setattr(context, "_HOLDS", set())
    ctx = Context(spark, SF)
    assert ctx.transactions.inputFiles() and all("/flagged/" in f or "/nation." in f or "/region." in f for f in ctx.transactions.inputFiles())
    assert context._HOLDS == {(ctx.fingerprint, "transactions")}
    monkeypatch.setattr(context, "_HOLDS", set())
    monkeypatch.setitem(context.CONTRACTS, "transactions", {"never": "order_id IS NOT NULL"})
    try:
        Context(spark, SF).transactions
        raise AssertionError("breach not seen")
    except ValueError as e:
        assert "transactions breaks its contract" in str(e)


def test_contract_checks_deal_a_table_once(spark):
    rows = spark.range(200).selectExpr("id % 150 AS k", "'a' AS restaurant_name", "cast(id % 150 AS double) AS amount")
    checks = quality.contract_checks(quality.without_repeats(rows, ["k"]), "t", ["k"], ["k"], rows.columns, money_fields=["amount"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert checks._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert {r.rule: r.invalid_rows for r in checks.collect()}["Unique primary key"] == 0


def test_duplicate_audit_counts_rows_and_kinds_in_one_pass(spark):
    rows = spark.createDataFrame([(1, None, 0.5), (1, None, 0.5), (1, "x", 0.5), (2, "x", None), (None, None, None), (None, None, None)], "k int, t string, v double")
    audit = quality.duplicate_audit({"t": rows, "none": rows.limit(0)}, {"t": ["k"]})
    assert sorted(map(tuple, audit.collect())) == [("none", 0, 0, 0), ("t", 6, 4, 2)]
    assert audit._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1  # the empty table has none


def test_right_children_come_from_their_parents_and_sums_travel_packed():
    import numpy as np

    from opsledger.operators import histogram_boosting as hb

    rng = np.random.default_rng(3)
    bins, gradient = rng.integers(0, 40, (900, 2)), rng.integers(-(10**9), 10**9, 900)
    p = hb.Params(leaves=6)
    grown = hb.Growing(p)
    asked = 0
    while want := grown.wanted():
        nodes = grown.asked()
        asked += len(nodes)
        assert len(nodes) <= len(want) / 2 or want == {1}
        at = hb.routed(bins, grown.splits())
        sums = np.zeros((2, len(nodes), 2, 256))
        for i, node in enumerate(nodes):
            for f in range(2):
                here = at == node
                sums[0, i, f] = np.bincount(bins[here, f], minlength=256)
                sums[1, i, f] = np.bincount(bins[here, f], gradient[here], minlength=256)
        packed = hb._packed(sums)
        assert len(packed) < sums.nbytes / 4 and (hb._unpacked(packed) == sums.ravel()).all()
        grown.take(nodes, *sums)
    at = hb.routed(bins, grown.splits())
    for node, (n, g) in grown.sums.items():
        here = np.isin(at, [k for k in range(1, 1 << 12) if any(k >> s == node for s in range(12))])
        if node in grown.tree().nodes:
            assert n[0].sum() == n[1].sum() == here.sum() and g[0].sum() == gradient[here].sum()


def _file_hash(path):
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def test_manifest_streams_files_of_any_length_and_name(spark, tmp_path, monkeypatch):
    table, n = tmp_path / "events.parquet", blocks.BLOCK
    names = ["a, b.parquet", "{x,y}*[z]?.parquet", "back\\slash}.parquet", "per%20cent é.parquet", "packed.gz"]
    lengths = [1, n - 1, n, n + 1, 2 * n - 1, 2 * n, 2 * n + 1, 5 * n + 7]
    for i, (name, length) in enumerate([*((x, 3 * n + 5) for x in names), *((f"{x}.parquet", x) for x in lengths)]):
        folder = table / ("day=1, {2}" if i % 2 else "day=2")
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(os.urandom(length))
    want = {(p.name, p.stat().st_size, _file_hash(p)) for p in table.glob("*/*")}
    assert len(want) == len(names) + len(lengths)
    link = "fs.viewfs.mounttable.manifest.link./in"  # a store that only Spark's readers can open
    spark.conf.set(link, f"file://{tmp_path}")
    try:
        for whole, together, folder in ((0, 100, tmp_path), (n, 4, tmp_path), (2 * n, 1, "viewfs://manifest/in"), (1 << 20, 100, tmp_path)):
            monkeypatch.setattr(bundle, "TOGETHER", together)
            rows = bundle.source_manifest(spark, str(folder), ["events"], whole).collect()
            assert {r["table"] for r in rows} == {"events"} and len(rows) == len(want)
            assert {(r["file"], r["bytes"], r["sha256"]) for r in rows} == want
    finally:
        spark.conf.unset(link)


def test_manifest_has_files_that_no_cell_holds(spark, tmp_path):
    path = tmp_path / "lineitem.parquet"
    with open(path, "wb") as f:  # takes no room on the disk: what is not written is zeros
        f.write(b"PAR1")
        f.truncate((2 << 30) + 5)
    (tmp_path / "nation.parquet").write_bytes(b"small")
    rows = {r["table"]: r for r in bundle.source_manifest(spark, str(tmp_path), ["lineitem", "nation"]).collect()}
    assert rows["lineitem"]["bytes"] == (2 << 30) + 5 and rows["lineitem"]["sha256"] == _file_hash(path)
    assert rows["nation"]["sha256"] == hashlib.sha256(b"small").hexdigest()
