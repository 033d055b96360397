"""Vector codes against plain rounds, fill-in-middle against plain Python."""

import hashlib
import math
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsledger.llm import ball_kmeans, fill_in_middle, queries
from opsledger.llm.wavelet import WaveletMatrix

SF = os.environ.get("OPSLEDGER_TEST_SF", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", ["op12_vector_codes", "op13_fill_in_middle"])
def test_matches_sql(name, spark, duck):
    got = Counter(map(tuple, queries.QUERIES[name](spark, SF).collect()))
    want = duck.execute(queries.ORACLE[name])
    columns = [c[0] for c in want.description]
    assert columns == queries.QUERIES[name](spark, SF).columns
    assert got == Counter(want.fetchall())


def plain_codes(rows, parts, entries, rounds, scale):
    """All distances with Python integers: {row index: (code, error)}, entries by part."""
    ok = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    ok.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not ok:
        return [], ""
    length = len(ok[0][1])
    ok = [r for r in ok if len(r[1]) == length]
    width = -(-length // parts)
    cut = []
    for _, v, _ in ok:
        x = [math.floor(scale * y) if abs(y) < 2**40 else int(y) * scale for y in v] + [0] * (width * parts - length)
        cut.append([x[p * width : (p + 1) * width] for p in range(parts)])
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for c in cut:
                groups[nearest(c[p], books[p])[1]].append(c[p])
            for k, g in groups.items():
                books[p][k] = [sum(col) // len(g) for col in zip(*g)]
    out = []
    for r, c in zip(ok, cut):
        best = [nearest(c[p], books[p]) for p in range(parts)]
        out.append((r[0], "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), r[2]))
    by_label = Counter()
    for _, _, e, label in out:
        by_label[label] += e
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return [(i, c, e, by_label[label], digest) for i, c, e, label in out], digest


def random_rows(seed, n, length, kind):
    rnd = random.Random(seed)
    rows = []
    for k in range(n):
        if kind == "ties":
            v = [rnd.choice([0.0, 0.5, 1.0]) for _ in range(length)]
        elif kind == "wide":
            v = [rnd.choice([2e5, -2e5, 3.0]) * rnd.random() // 1 for _ in range(length)]
        else:
            centre = rnd.choice([-0.5, 0.0, 0.7])
            v = [centre + rnd.gauss(0, 0.05) for _ in range(length)]
        rows.append((k * 3, v, rnd.choice([1, 2, None])))
    return rows


@pytest.mark.parametrize(("kind", "n", "length", "entries"), [("balls", 300, 8, 16), ("ties", 200, 8, 16), ("ties", 60, 4, 256), ("balls", 90, 6, 5), ("wide", 25, 4, 4)])
def test_codes_equal_plain_rounds(spark, kind, n, length, entries):
    rows = random_rows(n, n, length, kind)
    odd = [(901, None, 1), (902, [None] * length, 1), (903, [float("nan")] * length, 2), (904, [float("inf")] + [0.0] * (length - 1), None), (905, [1.0], 1)]
    rows += odd + [rows[3], rows[3], (None, rows[5][1], 2), ((1 << 60) + 1, rows[6][1], None)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("code", F.lit("clash"))
    got = ball_kmeans.vector_codes(table, entries=entries)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    want, _ = plain_codes(rows, 4, entries, 4, 1024)
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_codes_of_empty_and_unusable_tables(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert ball_kmeans.vector_codes(empty).collect() == []
    none = spark.createDataFrame([(1, None, 1), (2, [float("nan")], 1)], "vec_id long, embedding array<float>, label int")
    assert ball_kmeans.vector_codes(none).collect() == []
    zero = spark.createDataFrame([(1, [], 1), (2, [], 1)], "vec_id long, embedding array<float>, label int")
    assert [(r.vec_id, r.code, r.error) for r in ball_kmeans.vector_codes(zero).orderBy("vec_id").collect()] == [(1, "00000000", 0), (2, "00000000", 0)]


def test_balls_skip_work():
    rnd = np.random.default_rng(1)
    centres = rnd.integers(-5000, 5000, (64, 8))
    x = np.repeat(centres, 50, 0) + rnd.integers(-40, 40, (3200, 8))
    code = np.repeat(np.arange(64), 50)
    new, compared = ball_kmeans.reassign(x, code, centres, ball_kmeans.squared(centres, centres))
    assert (new == ball_kmeans.first_assignment(x, centres)).all()
    assert compared < 0.1 * x.shape[0] * 64
    wrong = rnd.integers(0, 64, 3200)
    assert (ball_kmeans.reassign(x, wrong, centres, ball_kmeans.squared(centres, centres))[0] == code).all()


def test_stored_rounds_are_removed(spark):
    from opsledger.llm.common import shared_folder

    folder = shared_folder(spark).removeprefix("file:")
    before = {d for d in os.listdir(folder) if d.startswith("llm-ball-round") or d.startswith("llm-ball-blocks")}
    queries.op12_vector_codes(spark, SF).collect()
    after = {d for d in os.listdir(folder) if d.startswith("llm-ball-round") or d.startswith("llm-ball-blocks")}
    assert after <= before


@pytest.mark.parametrize("seed", range(5))
def test_wavelet_ranks_and_selects(seed):
    rnd = np.random.default_rng(seed)
    codes = rnd.integers(0, 4, int(rnd.integers(0, 700))).astype(np.uint8)
    matrix, places = WaveletMatrix(codes), np.arange(codes.size + 1)
    for wanted in [(0,), (1,), (2,), (3,), (1, 2, 3)]:
        hits = np.isin(codes, wanted)
        ranks = np.concatenate(([0], np.cumsum(hits)))
        assert (matrix.ranks(wanted, places) == ranks).all()
        assert (matrix.select(wanted, np.arange(1, hits.sum() + 1)) == np.flatnonzero(hits) + 1).all()


def plain_middle(i, text, pattern, percent=100, spm=50, salt="7"):
    text = text or ""
    units = re.findall(pattern, text)
    h = hashlib.sha256(f"{salt}:{'' if i is None else i}".encode()).hexdigest()
    draws = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(d % (len(units) + 1) for d in draws[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or draws[2] % 100 >= percent:
        return len(units), "plain", None, None, text
    if draws[3] % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize(("unit", "pattern", "how"), [("line", r"[^\n]*\n|[^\n]+", {}), ("piece", r"[^\x20\x09-\x0d]*[\x20\x09-\x0d]|[^\x20\x09-\x0d]+", {"percent": 70, "spm_percent": 20, "salt": "x"})])
def test_middle_equals_plain_python(spark, unit, pattern, how):
    rnd = random.Random(unit)
    texts = [None, "", "\n", "\n\n\n", "a", "a\n", "é😀\nb\rc\n", "<P>x\ny", "a<S", "<\n<S\n<M\nP>", "x<M>", "l" * 50 + "\n" + "w\n" * 3_000_000]
    texts += ["".join(rnd.choice("ab<PSM> \n\té😀") for _ in range(rnd.randint(1, 80))) for _ in range(300)]
    rows = [(k, t, "c") for k, t in enumerate(texts)] + [(None, "n\nu\nll", "c"), (7, texts[7], "c"), (20, texts[20], "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __cut string")
    out = fill_in_middle.digests(docs, unit=unit, **how)
    assert set(out.columns) == {"doc_id", "text", "__cut", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256", "restored_sha256"}
    plain = {"percent": 100, "spm": how.get("spm_percent", 50), "salt": how.get("salt", "7")} | ({"percent": how["percent"]} if how else {})

    def sha(x):
        return hashlib.sha256(x.encode()).hexdigest()

    want = Counter()
    for i, t, _ in rows:
        n, form, p, m, output = plain_middle(i, t, pattern, **plain)
        want[(i, n, form, p, m, sha(output), sha(t or ""))] += 1
    got = Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) for r in out.drop("text", "output").collect())
    assert got == want
    assert {r.form for r in out.select("form").collect()} == {"plain", "psm", "spm"}


def test_middle_of_an_empty_table(spark):
    assert fill_in_middle.digests(spark.createDataFrame([], "doc_id long, text string")).collect() == []
