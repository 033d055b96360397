"""URL, vector and model operators against brute force and held-out labels; the pipeline."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsledger.llm import near_vectors, quality, queries, topk, toxicity, url_filter

# URLs -----------------------------------------------------------------------------------------


def brute_url(url, listed):
    def parts(u):
        if u is None or "://" not in u:
            return "", "", None
        rest = u.split("://", 1)[1]
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        query = re.match(r"[^#]*?\?([^#]*)", u, re.S)
        args = sorted(a for a in (query[1].split("&") if query else []) if a and not re.match("(ref|fbclid|gclid|utm_[^=]*)(=|$)", a))
        return host, path, re.sub(":(80|443)$", "", host) + path.rstrip("/") + ("?" + "&".join(args) if args else "")

    host, path, canonical = parts(url)
    fit = [(len(h + p), h + p, k) for k, h, p in queries.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fit:
        return host, path, max(fit)[1], max(fit)[2]
    names = {parts(u)[2] for u in listed} - {None}
    return host, path, None, "block" if canonical in names else "allow"


def test_urls_equal_brute_force(spark):
    random.seed(2)
    hosts = ["a.net", "WWW.A.net:80", "example.org", "x.example.org", "badexample.org", "m.c.com", "com", "ÄB.net", "", "org"]
    paths = ["", "/", "/es/1", "/en/1", "/en/12/", "/fr/", "/de/x?utm_source=1&b=2&a=1", "/x#frag?no", "?q=1", "/de/y://z"]
    urls = [random.choice(["http://", "https://", "ftp://", "", "HTTP://"]) + random.choice(hosts) + random.choice(paths) for _ in range(600)]
    urls += [None, "", "://", "no scheme/x", "http://" + "a" * 50_000, "http://a.net/\nx"] + ["http://hot.net/p"] * 300
    listed = urls[::3] + [None, "http://hot.net/p/"]
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("rule", T.StringType()), T.StructField("__url", T.StringType())])
    pages = spark.createDataFrame([(i, u, "r", "x") for i, u in enumerate(urls)], schema)
    flagged = spark.createDataFrame([(u,) for u in listed], "url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages, flagged, queries.RULES).collect()}
    assert got == {i: brute_url(u, listed) for i, u in enumerate(urls)}
    none = url_filter.judge_urls(pages, flagged.limit(0), queries.RULES)
    assert {r.verdict for r in none.where("rule IS NULL").collect()} == {"allow"}
    assert url_filter.judge_urls(pages.limit(0), flagged, queries.RULES).count() == 0


def test_filter_blocks_have_no_false_negative(spark):
    listed = spark.range(3000).select(F.concat(F.lit("h/"), "id").alias("canonical"))
    blocks = url_filter.bloom_blocks(listed, 40)
    probe = spark.range(9000).select("id", F.concat(F.lit("h/"), "id").alias("canonical")).withColumn("block", url_filter._block(F.col("canonical"), 40))
    held = F.lit(True)
    for i, m in enumerate(url_filter._masks(F.col("canonical"))):
        held = held & (F.col(f"w{i}").bitwiseAND(m) == m)
    hits = {r.id for r in probe.join(blocks, "block").where(held).collect()}
    assert set(range(3000)) <= hits and len(hits) < 9000


# vectors --------------------------------------------------------------------------------------

VEC = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()), T.StructField("cell", T.StringType())])


def vectors(spark, seed=1, n=500, dim=16, labels=3, scale=None):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        kind = rng.random()
        if rows and kind < 0.25:
            v = np.array(rows[int(rng.integers(len(rows)))][1]) + rng.normal(0, 0.03, dim)
        elif rows and kind < 0.35:
            v = np.array(rows[0][1]) + rng.normal(0, 0.01, dim)  # one hot neighbourhood
        elif rows and kind < 0.4:
            v = np.array(rows[int(rng.integers(len(rows)))][1]) * 2  # same direction
        else:
            v = rng.normal(0, 1, dim) * (scale or 1) ** rng.random()
        rows.append((i, [float(x) for x in np.float32(v)], int(rng.integers(labels)) if i else 0))
    nan, inf = float("nan"), float("inf")
    rows += [(n, None, 1), (n + 1, [], 1), (n + 2, [0.0] * dim, 1), (n + 3, [nan] * dim, 1), (n + 4, [inf] * dim, 1), (n + 5, [None, *[1.0] * (dim - 1)], 1)]
    rows += [(n + 6, rows[0][1], None), (None, rows[0][1], 0), (n + 7, [1.0, 2.0], 0), (n + 8, [1.0, 2.001], 0), (n + 9, [1.0, 2.0], 1), (n + 10, rows[0][1], 0), (n + 10, rows[0][1], 0)]
    rows += [(n + 50 + i, rows[3][1], 2) for i in range(60)]  # copies
    return rows, spark.createDataFrame([(*r, "c") for r in rows], VEC)


def usable(v):
    return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v)


def brute_near(rows, cosine):
    ok = [i for i, (d, v, lab) in enumerate(rows) if d is not None and lab is not None and usable(v) and any(v)]
    root, n = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    unit = {i: np.array(rows[i][1]) / np.sqrt((np.array(rows[i][1]) ** 2).sum()) for i in ok}
    for a in ok:
        for b in ok:
            if a < b and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine:
                n[a] += 1
                n[b] += 1
                root[max(find(a), find(b))] = min(find(a), find(b))
    low = defaultdict(list)
    for i, r in enumerate(rows):
        low[find(i)].append(r[0])
    component = [r[0] if r[0] is None else min(low[find(i)]) for i, r in enumerate(rows)]
    return Counter((r[0], k, c, r[0] == c) for r, k, c in zip(rows, n, component))


@pytest.mark.parametrize("chunk", [16, 2048])
def test_near_vectors_equal_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(near_vectors, "CHUNK_ROWS", chunk)
    rows, df = vectors(spark)
    got = near_vectors.near_vectors(df, 0.98, per_cell=4).collect()
    assert Counter(tuple(r) for r in got) == brute_near(rows, 0.98)
    assert max(r.n_links for r in got) > 20


def test_near_vectors_recall_and_empty(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    want = {d: n for d, n, _, _ in brute_near(rows, 0.98)}
    for recall, least in ((1.0, 1.0), (0.95, 0.9)):
        got = {r.vec_id: r.n_links for r in near_vectors.near_vectors(df, 0.98, recall=recall).collect()}
        assert sum(got.values()) >= least * sum(want.values())
        assert all(got[d] <= n for d, n in want.items())
    assert near_vectors.near_vectors(df.limit(0)).count() == 0


def brute_top(rows, k, scale=256):
    ok = [(d, [int(np.floor(float(x) * scale)) for x in v]) for d, v, *_ in rows if d is not None and v is not None and usable(v or [0])]
    out = Counter()
    for q in {(d, tuple(v)) for d, v in ok if d % 10 == 0}:
        found = sorted((-sum(a * b for a, b in zip(q[1], v)), d) for d, v in ok if d != q[0] and len(v) == len(q[1]))[:k]
        out.update((q[0], i + 1, d, -s) for i, (s, d) in enumerate(found))
    return out


@pytest.mark.parametrize("scale,chunk", [(None, 32), (200.0, 32), (200.0, 8192)])
def test_top_k_equals_brute_force(spark, monkeypatch, scale, chunk):
    monkeypatch.setattr(topk, "CHUNK_ROWS", chunk)
    rows, df = vectors(spark, 4, scale=scale)
    got = topk.top_k(df, F.col("vec_id") % 10 == 0, 5)
    assert Counter(tuple(r) for r in got.collect()) == brute_top(rows, 5)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 10 == 0, 5).count() == 0
    few = topk.top_k(df.where("vec_id < 3"), F.col("vec_id") % 10 == 0, 5)
    assert Counter(tuple(r) for r in few.collect()) == brute_top(rows[:3], 5)


def test_products_are_exact_or_refused():
    big = np.array([[2**40 + 1, 3], [5, -7]], np.int64)
    assert topk._products(big, np.array([2**20 + 1, 1])).tolist() == [(2**40 + 1) * (2**20 + 1) + 3, 5 * (2**20 + 1) - 7]
    assert topk._products(np.array([[2**61, -(2**61)]]), np.array([2, 2])).tolist() == [0]
    with pytest.raises(ValueError):
        topk._products(np.array([[2**61, 2**61]]), np.array([2, 2]))


def test_top_k_prunes(monkeypatch):
    """Lengths and coordinates leave out most rows, and never one of the best."""
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(0, 100, (2000, 8)))
    norms = np.sqrt((x * x).sum(1))
    chunk = topk._Chunk(np.arange(2000), x, norms)
    for i in range(50):
        q = x[i] + np.floor(rng.normal(0, 10, 8))
        scores = np.sort(x @ q)[::-1]
        rows = chunk.candidates(q, float(np.sqrt((q * q).sum())), float(scores[4]))
        ids, got = chunk.search(-1, q, float(np.sqrt((q * q).sum())), float(scores[4]), 5)
        assert (got == scores[:5]).all()
        kept = len(range(2000)[rows]) if isinstance(rows, slice) else len(rows)
        assert kept < 2000


# models ---------------------------------------------------------------------------------------

BIG = SF.replace("sf0.001", "sf0.01")


def test_quality_on_held_out_labels(spark):
    scored = queries.op5_quality(spark, BIG)
    assert scored.schema.simpleString() == "struct<doc_id:bigint,held_out:boolean,score:double,predicted:int>"
    rows = {r.doc_id: r for r in scored.collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for d, r in rows.items())
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{BIG}/labels.parquet").collect()}
    held = [(rows[d].predicted, y) for d, y in labels.items() if d in rows and rows[d].held_out]
    good = [p == y for p, y in held]
    assert len(held) > 40 and np.mean(good) > max(np.mean([y for _, y in held]), 0.85)


ODD_DOCS = [(1, None), (2, ""), (3, " \n\t"), (None, "no id"), (5, "z" * 300_000), (5, "z"), (7, "word " * 50_000), (8, "idiot scum")]


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame([(*r, 1.0) for r in ODD_DOCS], "doc_id long, text string, score double")
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    taught = spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "text", F.lit(1.0).alias("score"))
    got = quality.score_quality(docs.withColumn("doc_id", F.col("doc_id") - 100).union(taught), labels).where("doc_id < 0 OR doc_id IS NULL").collect()
    assert len(got) == len(ODD_DOCS) and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in quality.score_quality(docs, labels.limit(0)).collect()} == {0.5}
    clash = spark.createDataFrame([(2, 1), (2, 0), (8, 1), (None, 1), (7, None)], "doc_id long, quality int")
    assert {r.score for r in quality.score_quality(docs, clash).collect()} <= {0.5, 1.0}
    assert quality.score_quality(docs.limit(0), labels).count() == 0


def test_quality_ignores_held_out_labels(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted((r.doc_id, round(r.score, 9)) for r in quality.score_quality(docs, x).collect()) for x in (labels, turned))
    assert a == b


def test_toxicity_on_left_out_labels(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    got = toxicity.judge_toxicity(docs, labels.where("doc_id % 3 <> 0"), least=2).collect()
    named = re.compile("(?i)(?<![a-z])(idiot|moron|loser|scum|clown|trash|stupid|pathetic|worthless|disgusting)(?![a-z])")
    truth = {r.doc_id: bool(named.search(r.text)) for r in docs.collect()}
    flags = [(r.rejected, truth[r.doc_id]) for r in got if r.doc_id % 3 == 0]
    assert sum(t for _, t in flags) > 10
    assert np.mean([r for r, t in flags if t]) > 0.9 and np.mean([r for r, t in flags if not t]) < 0.02


def test_chain_uses_out_of_fold_probabilities():
    rng = np.random.default_rng(0)
    x = (rng.random((600, 5)) < 0.3).astype(float)
    a = (x[:, 0] + (rng.random(600) < 0.1) > 0).astype(float)
    b = np.where(rng.random(600) < 0.95, a, 1 - a)  # follows the first category
    fold = np.arange(600) % toxicity.FOLDS
    links = toxicity.train_chain(x, np.c_[a, b], np.ones(600), fold, 1.0)
    assert len(links[0]) == 6 and len(links[1]) == 7 and links[1][5] > 1
    p = toxicity.apply_chain(x, links)
    assert np.mean((p[:, 1] > 0.5) == (p[:, 0] > 0.5)) > 0.95


def test_toxicity_of_odd_rows(spark):
    taught = [(100 + i, "what an idiot and scum" if i % 2 else "what a fine day") for i in range(40)]
    rows = ODD_DOCS + taught
    docs = spark.createDataFrame([(*r, True) for r in rows], "doc_id long, text string, rejected boolean")
    labels = [(d, int(d % 2)) for d, _ in taught] + [(8, 1), (7, 0), (2, 0), (5, 1), (5, 0), (None, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.judge_toxicity(docs, labels, least=1).collect()
    bad = {8, *(d for d, _ in taught if d % 2)}
    assert len(got) == len(rows) and {r.doc_id for r in got if r.rejected} == bad
    clean = toxicity.keep_clean(docs, labels, least=1)
    assert clean.columns == docs.columns and clean.count() == len(rows) - len(bad)
    none = toxicity.judge_toxicity(docs, labels.where("toxic = 0")).collect()
    assert len(none) == len(rows) and not any(r.rejected or r.p_toxic for r in none)
    assert toxicity.judge_toxicity(docs.limit(0), labels).count() == 0


# registered queries and the pipeline ------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    want = duck.execute(queries.ORACLE[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    norm = lambda d: Counter(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in d[cols].astype(object).where(d[cols].notna(), None).itertuples(index=False))
    assert norm(got) == norm(want)


def test_pipeline_stages(spark):
    import sys
    from pathlib import Path

    sys.path.insert(0, str(Path(__file__).parents[2]))
    import corpus_pipeline as P
    from test_llm_text import brute_classes, brute_lines, brute_mix

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    read = lambda d: [(r.doc_id, r.text, r.source) for r in d.collect()]
    steps = dict(P.STAGES)
    assert list(steps) == ["toxicity", "line_dedup", "near_copies", "source_mix", "packing"]
    clean = steps["toxicity"](spark, docs, SF).cache()
    chain = toxicity.judge_toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet")).where("NOT rejected")
    assert clean.columns == docs.columns and sorted(r[0] for r in read(clean)) == sorted(r.doc_id for r in chain.collect())
    lines = steps["line_dedup"](spark, clean, SF).cache()
    assert Counter((d, t) for d, t, _ in read(lines)) == Counter({(d, t): n for (d, _, _, t), n in brute_lines(read(clean), 0.05, 5).items()})
    one = steps["near_copies"](spark, lines.unionByName(lines.limit(5)), SF).cache()
    want = {d for d, _, c in brute_classes(read(lines), 5, 80) if d == c}
    assert one.columns == docs.columns and sorted(r[0] for r in read(one)) == sorted(want)
    mixed = steps["source_mix"](spark, one, SF).cache()
    taken = Counter()
    for d, t, _ in read(mixed):
        taken[d] += len(t.split())
    assert mixed.columns == docs.columns
    assert {d: n for d, n in taken.items() if n} == {d: t for d, _, _, _, t in brute_mix(read(one)) if t}
    packed = steps["packing"](spark, mixed, SF)
    assert packed.where("piece = 0").count() == mixed.count()
    whole = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert all(r.n == r.end <= 1024 for r in whole)


def test_pipeline_stages_on_odd_rows(spark):
    """Null ids and texts, empty and long texts, repeated rows, extra columns and an empty table."""
    import sys
    from pathlib import Path

    sys.path.insert(0, str(Path(__file__).parents[2]))
    import corpus_pipeline as P

    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base), (1, base), (2, base), (3, base + "x"), (None, base), (None, None), (4, None), (5, ""), (6, " \t"), (7, " ".join(f"l{i}" for i in range(20_000)))]
    schema = "doc_id long, text string, lang string, source string, n_chars long, n_lines int, component_id long"
    docs = spark.createDataFrame([(d, t, None, None if d == 4 else "s", None, 9, 9) for d, t in rows], schema)
    steps = dict(P.STAGES)
    read = lambda df: Counter((r.doc_id, r.text, r.n_chars) for r in df.collect())
    size = lambda t: None if t is None else len(t)
    clean = steps["toxicity"](spark, docs, SF)
    assert tuple(clean.columns) == P.COLUMNS and read(clean) == Counter((d, t, size(t)) for d, t in rows)
    assert read(steps["line_dedup"](spark, docs, SF)) == read(clean)
    one = steps["near_copies"](spark, docs, SF)
    assert tuple(one.columns) == P.COLUMNS and read(one) == Counter((d, t, size(t)) for d, t in [rows[0], *rows[4:]])
    for name in ("line_dedup", "near_copies", "source_mix", "packing"):
        assert steps[name](spark, docs.limit(0).select(*P.COLUMNS), SF).count() == 0
