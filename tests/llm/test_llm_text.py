"""Text operators against brute force: mixing, lines, shingles, tokens, packing."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from opsledger.llm import bin_completion, line_dedup, mixing, ngram_join, packing, queries, token_counts

WORD = re.compile("[^\x20\x09-\x0d]+")
DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame([(*r, *(None,) * (3 - len(r))) for r in rows], DOC)


ODD = [
    (1, None, None),
    (2, "", "a"),
    (3, " \t\n\x0b\x0c\r", "a"),
    (None, "null id here with words", "b"),
    (5, "same row", "b"),
    (5, "same row", "b"),
    (5, "other text with one id", None),
    (7, "x" * 200_000, "ä"),
    (8, "many words " * 60_000, "Z"),
    (9, "line\n\nline\n  line \t\n", "a"),
    (10, "déjà vu 　 \xa0 日本 ▁ <|endoftext|> </s> <unk> \0 😀", "b"),
]


def clash(df):
    """Extra columns whose names operators use themselves."""
    from pyspark.sql import functions as F

    names = ("size", "key", "n", "bucket", "gid", "cid", "token", "rank", "part", "nth", "hash", "line", "page", "h", "s", "target", "taken", "n_lines", "component_id", "__key", "__source", "__lines")
    return df.withColumns({c: F.lit(7) for c in names})


# mixing ---------------------------------------------------------------------------------------


def brute_mix(rows, weights=(1, 2, 3), most=3.0):
    import hashlib

    size = [len(WORD.findall(t or "")) for _, t, _ in rows]
    total = defaultdict(int)
    for (_, _, s), n in zip(rows, size):
        total[s] += n
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(total.values()))
    while free:
        level = left / sum(w[s] for s in free)
        over = {s for s in free if w[s] * level >= most * total[s]}
        if not over:
            target |= {s: w[s] * level for s in free}
            break
        target |= {s: most * total[s] for s in over}
        left -= sum(most * total[s] for s in over)
        free -= over
    key = [int(hashlib.md5(f"mix:{'' if d is None else d}".encode()).hexdigest()[:15], 16) for d, _, _ in rows]
    taken = [0] * len(rows)
    for s in order:
        goal, epochs = int(target[s]), int(target[s]) // total[s] if total[s] else 0
        rest = goal - epochs * total[s]
        own = sorted((key[i], i) for i, r in enumerate(rows) if r[2] == s)
        for k in sorted({k for k, _ in own}):
            tied = [i for kk, i in own if kk == k]
            whole = sum(size[i] for i in tied)
            for i in tied:
                taken[i] = epochs * size[i] + (size[i] if whole <= rest else size[i] * max(rest, 0) // max(whole, 1))
            rest -= whole
    return Counter((d, n, total[s], round(target[s], 6), t) for (d, _, s), n, t in zip(rows, size, taken))


def test_mix_equals_brute_force(spark):
    random.seed(3)
    rows = [(i, "w " * random.randint(0, 60), random.choice(["a", "b", "c", "ä", None, "hot", "hot", "hot"])) for i in range(400)] + ODD
    got = mixing.mix_sources(clash(frame(spark, rows))).collect()
    assert Counter((r.doc_id, r["size"], r.source_size, round(r["target"], 6), r["taken"]) for r in got) == brute_mix(rows)
    budgets = defaultdict(int)
    for r in got:
        assert r["taken"] <= 3 * r["size"]
        budgets[r.source] += r["taken"]
    goal = {r.source: r["target"] for r in got}
    assert all(goal[s] - 3 <= n <= goal[s] for s, n in budgets.items())


def test_mix_copies_and_empty(spark):
    rows = [(1, "a b c d", "x"), (2, "e f", "y"), (3, "", "y")]
    mixed = mixing.mix_sources(frame(spark, rows))
    taken = {r.doc_id: r["taken"] for r in mixed.collect()}
    out = mixing.mixed_documents(mixed).collect()
    words = Counter()
    for r in out:
        words[r.doc_id] += len(r.text.split())
    assert {k: v for k, v in taken.items() if v} == {k: v for k, v in words.items() if v}
    assert sum(r.doc_id == 3 for r in out) == 1
    assert mixing.mix_sources(frame(spark, [])).count() == 0


# lines ----------------------------------------------------------------------------------------


def brute_lines(rows, ratio, least):
    pages = defaultdict(set)
    for _, t, s in rows:
        if t is not None:
            pages[s].add(t)
    gap = " \t\n\x0b\x0c\r"
    bad = set()
    for s, texts in pages.items():
        n = Counter(x for t in texts for x in {y.strip(gap) for y in t.split("\n")} if x)
        bad |= {(s, x) for x, k in n.items() if k >= least and k > ratio * len(texts)}
    out = []
    for d, t, s in rows:
        lines = [] if t is None else t.split("\n")
        kept = [x for x in lines if (s, x.strip(gap)) not in bad]
        out.append((d, len(lines), len(lines) - len(kept), None if t is None else "\n".join(kept)))
    return Counter(out)


def test_lines_equal_brute_force(spark):
    random.seed(5)
    common = [f"common {i}" for i in range(6)]
    rows = [(i, "\n".join(random.choice([f"own {i} {j}", random.choice(common), " " + random.choice(common) + "\t", ""]) for j in range(6)), random.choice(["a", "b", "b", None])) for i in range(300)]
    rows += [(1000 + i, rows[0][1], "a") for i in range(60)] + ODD  # copies count once
    got = line_dedup.drop_boilerplate(clash(frame(spark, rows)), ratio=0.3, least_pages=20).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got) == brute_lines(rows, 0.3, 20)
    assert sum(r.n_dropped for r in got) > 0
    assert line_dedup.drop_boilerplate(frame(spark, [])).count() == 0


def test_small_hosts_are_judged(spark):
    """A footer on six of eight pages goes; what stands on four pages stays, also when that is all of a host."""
    rows = [(i, f"own {i}\n{'footer' if i < 6 else 'other'}", "small") for i in range(8)]
    rows += [(100 + i, f"own {i}\nfooter", "tiny") for i in range(4)]
    got = line_dedup.drop_boilerplate(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got) == brute_lines(rows, 0.05, 5)
    assert {r.doc_id for r in got if r.n_dropped} == set(range(6))


def brute_site_lines(rows, ratio, least, alike):
    gap = " \t\n\x0b\x0c\r"
    pages = defaultdict(dict)
    for _, t, s in rows:
        if t is not None:
            pages[s][t] = {x for y in t.split("\n") if (x := y.strip(gap))}
    bad = set()
    for s, sets in pages.items():
        vote = {t: t for t in sets}
        for a in sets:
            for b in sets:
                if sets[a] and vote[a] != vote[b] and 100 * len(sets[a] & sets[b]) >= alike * len(sets[a] | sets[b]):
                    old = vote[b]
                    vote = {t: vote[a] if v == old else v for t, v in vote.items()}
        voters = defaultdict(set)
        for t, lines in sets.items():
            for x in lines:
                voters[x].add(vote[t])
        bad |= {(s, x) for x, v in voters.items() if len(v) >= least and len(v) > ratio * len(set(vote.values()))}
    return Counter((d, n := len(t.split("\n")) if t is not None else 0, n - len(k), None if t is None else "\n".join(k)) for d, t, s in rows for k in [[x for x in t.split("\n") if (s, x.strip(gap)) not in bad] if t is not None else []])


def test_small_sites_lose_boilerplate_and_near_copies_keep_their_text(spark):
    random.seed(6)
    own = lambda i: [f"own {i} {j}" for j in range(6)]
    rows = [(50 + i, "\n".join([" menu", *own(i), "foot\t"]), "small") for i in range(8)]  # 8 pages: below any size switch
    rows += [(100 + i, "\n".join(own(100 + i)), "big") for i in range(60)]
    rows += [(200 + i, "\n".join(["two pages share this", *own(200 + i)]), "big") for i in range(2)]
    rows += [(300 + i, "\n".join([*(f"copied {j}" for j in range(12)), f"edit {i}"]), "big") for i in range(20)]  # near copies
    rows += [(400 + i, "\n".join(["nav", *own(400 + i)]), None) for i in range(5)] + ODD
    got = {r.doc_id: r for r in line_dedup.drop_site_lines(clash(frame(spark, rows))).collect()}
    assert all(got[50 + i].n_dropped == 2 and "menu" not in got[50 + i].text for i in range(8))
    assert all(got[d].n_dropped == 0 for d, _, s in rows if s == "big")
    assert all(got[400 + i].n_dropped == 1 for i in range(5))
    again = line_dedup.drop_site_lines(clash(frame(spark, rows)), ratio=0.05, least_votes=3, alike=50).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in again) == brute_site_lines(rows, 0.05, 3, 50)
    assert line_dedup.drop_site_lines(frame(spark, [])).count() == 0


# shingles -------------------------------------------------------------------------------------


def brute_classes(rows, words, percent):
    def shingles(t):
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()

    sets = [shingles(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    index = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            index[x].append(i)
    tried = set()
    for own in index.values():
        for a in range(len(own)):
            for b in range(a + 1, len(own)):
                if (own[a], own[b]) not in tried:
                    tried.add((own[a], own[b]))
                    x, y = sets[own[a]], sets[own[b]]
                    if 100 * len(x & y) >= percent * len(x | y):
                        root[max(find(own[a]), find(own[b]))] = min(find(own[a]), find(own[b]))
    low = defaultdict(list)
    for i, (d, *_) in enumerate(rows):
        if d is not None:
            low[find(i)].append(d)
    return Counter((d, len(s), min(low[find(i)], default=None) if s else d) for i, ((d, *_), s) in enumerate(zip(rows, sets)))


def near_copies(seed=1):
    random.seed(seed)
    word = lambda: random.choice("abcdefghij") + random.choice("klmnop") + str(random.randint(0, 60))
    passage = [word() for _ in range(60)]
    rows, doc = [], 0
    for _ in range(25):
        base = [word() for _ in range(random.choice([2, 3, 12, 40, 120, 200]))]
        if random.random() < 0.6:
            base[len(base) // 2 : len(base) // 2] = passage
        for _ in range(random.choice([1, 1, 2, 3, 30])):
            copy = [word() if random.random() < random.choice([0, 0.004, 0.01, 0.03]) else w for w in base]
            rows.append((doc, " ".join(copy).title() if doc % 3 == 0 else "\t".join(copy)))
            doc += 1
    return rows


@pytest.mark.parametrize("words,percent,seed", [(4, 85, 1), (5, 80, 2)])
def test_classes_equal_brute_force(spark, words, percent, seed):
    rows = near_copies(seed) + [(d, t) for d, t, _ in ODD if d != 8]
    got = ngram_join.jaccard_classes(clash(frame(spark, rows)), words, percent, share=0.8, least=3)
    want = brute_classes(rows, words, percent)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == want
    assert len({c for _, _, c in want}) < len(rows) - 20


def test_classes_of_given_documents_equal_brute_force(spark):
    from conftest import SF

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = queries.op9_ngram_jaccard_join(spark, SF).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_classes(rows, 4, 85)


def test_sketches_bound_the_difference():
    """Sketches of any two widths never differ on more bits than the sets, and tell near misses apart."""
    r = np.random.default_rng(3)
    sets = [np.unique(r.integers(0, 2**63, k).astype(np.uint64)) for k in (1, 5, 80, 300, 500, 900, 5000)]
    sets += [np.unique(np.concatenate([x[: max(1, x.size * 8 // 10)], r.integers(0, 2**63, 1 + x.size // 5).astype(np.uint64)])) for x in sets]
    sketches = ngram_join.Sketches([ngram_join._sketch(x) for x in sets])
    assert len(set(sketches.width.tolist())) >= 4
    a, b = (x.ravel() for x in np.indices((len(sets), len(sets))))
    differ = np.array([np.setxor1d(sets[i], sets[j]).size for i, j in zip(a, b)])
    assert sketches.within(a, b, differ).all()
    # A pair of 300 shingles at Jaccard 2/3 is far from the 66 differing shingles that 0.8 allows.
    assert not sketches.within(np.array([3]), np.array([10]), np.array([66]))[0]
    one = ngram_join.Sketches([])
    assert one.within(np.array([], int), np.array([], int), np.array([], int)).size == 0


def test_near_misses_are_settled_where_they_meet(spark):
    """A cluster whose members share most text but stay below the threshold sends hardly any pair on."""
    random.seed(9)
    base = [f"b{i}" for i in range(300)]
    rows = [(i, " ".join(f"x{i}-{j}" if random.random() < 0.05 else w for j, w in enumerate(base))) for i in range(120)]
    met, original = [], ngram_join._passing

    def counted(pairs, *rest):
        met.append(pairs.count())
        return original(pairs, *rest)

    ngram_join._passing = counted
    try:
        got = ngram_join.jaccard_classes(frame(spark, rows), 4, 85, share=0.8, least=3).collect()
    finally:
        ngram_join._passing = original
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_classes(rows, 4, 85)
    assert sum(met) < 4 * ngram_join.LOOKS * len(rows)


def test_classes_of_nothing(spark):
    assert ngram_join.jaccard_classes(frame(spark, [])).count() == 0
    got = ngram_join.jaccard_classes(frame(spark, [(1, None), (2, ""), (None, None)])).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in got if r.doc_id) == [(1, 0, 1), (2, 0, 2)]


def test_hot_group_makes_no_pairs(spark):
    """Near copies by the hundred: candidate pairs stay near the number of postings."""
    random.seed(9)
    base = [f"w{random.randint(0, 9999)}" for _ in range(150)]
    rows = [(i, " ".join(w if random.random() > 0.004 else f"z{i}" for w in base)) for i in range(300)]
    made = []
    original = ngram_join._verified

    def counted(docs, pairs, *a, **k):
        made.append(pairs.count())
        return original(docs, pairs, *a, **k)

    ngram_join._verified = counted
    try:
        got = ngram_join.jaccard_classes(frame(spark, rows), 4, 85).collect()
    finally:
        ngram_join._verified = original
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_classes(rows, 4, 85)
    assert sum(made) < 300 * 299 // 2 // 4


def test_linked_cluster_leaves_few_open_pairs(spark, monkeypatch):
    """Copies with up to three changed words: the first look joins what links, so the second sends few pairs on."""
    random.seed(4)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(400):
        text = list(base)
        for at in random.sample(range(150), random.choice([1, 1, 2, 2, 3])):
            text[at] = f"x{i}-{at}"
        rows.append((i, " ".join(text)))
    made, original = [], ngram_join._verified
    monkeypatch.setattr(ngram_join, "_verified", lambda docs, pairs, *rest: made.append(pairs.count()) or original(docs, pairs, *rest))
    got = ngram_join.jaccard_classes(frame(spark, rows), 4, 85, share=0.8, least=3).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_classes(rows, 4, 85)
    assert made[0] <= 2 * ngram_join.LOOKS * len(rows) and sum(made[1:]) < len(rows)


def test_texts_reach_python_in_small_batches(spark, monkeypatch):
    """A task of the join holds a few MB of texts at once, whatever the session says for other jobs."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, seen, original = spark.conf.get(key), [], ngram_join.stored
    monkeypatch.setattr(ngram_join, "stored", lambda df, tag: seen.append(spark.conf.get(key)) or original(df, tag))
    text = " ".join(f"w{i}" for i in range(3000))
    got = ngram_join.jaccard_classes(frame(spark, [(i, text) for i in range(2)]), 4, 85).collect()
    assert [(r.n_shingles, r.component_id) for r in got] == [(2997, 0)] * 2
    assert {int(x) for x in seen} == {4 << 20} and spark.conf.get(key) == before


def test_hot_list_is_dealt_to_many_tasks(spark):
    """A list of 3000 groups, all but 20 in one component: no task holds it and no insiders meet."""
    rows = [(7, g, 100 + g % 5, 1 if g < 3000 else g, 0, True, True) for g in range(3020)]
    rows += [(8, g, 100, 1, 0, True, True) for g in range(50)] + [(9, 1, 100, 1, 0, True, True), (9, 2, 400, 2, 0, True, True)]
    lists = spark.createDataFrame(rows, "token long, gid long, n long, comp long, own long, late boolean, short boolean")
    tasks = defaultdict(lambda: defaultdict(set))
    for r in ngram_join._meetings(lists, 85, 64).collect():
        tasks[r.task][r.side].add(r.gid)
    assert max(sum(map(len, t.values())) for t in tasks.values()) < 3 * 64
    met = Counter(frozenset((a, b)) for t in tasks.values() for a in t.get(0, ()) for b in t.get(1, ()))
    met += Counter(frozenset((a, b)) for t in tasks.values() for a in t.get(2, ()) for b in t.get(2, ()) if a < b)
    assert {frozenset((a, b)) for a in range(3000, 3020) for b in range(3020) if a != b} == set(met) and set(met.values()) == {1}


@pytest.mark.parametrize("block", [2, 9])
def test_classes_of_cut_lists_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = near_copies(3)
    got = ngram_join.jaccard_classes(frame(spark, rows), 4, 85, share=0.8, least=3)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == brute_classes(rows, 4, 85)


# tokens ---------------------------------------------------------------------------------------

BITS = ["a", "b", "the", "  ", " ", "\n", "é", "日", "😀", "▁", "\t", "\0", "aaaa", "****", "'s", "'store", " don't", "\xa0", "\x85", "<s>", "</s>", "<unk>", "<|endoftext|>", "123", "　", "½", "ing", "\x1c"]


def fuzz(n, seed):
    random.seed(seed)
    return ["".join(random.choice(BITS) for _ in range(random.randint(0, 30))) for _ in range(n)] + ["a" * 3000, " " * 500, "é" * 500, "", None]


def test_token_counts_equal_the_library(spark):
    import sentencepiece

    path = queries.tokenizer("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = [(i, t) for i, t in enumerate(fuzz(1500, 4))] + [(d, t) for d, t, _ in ODD]
    got = token_counts.token_counts(clash(frame(spark, rows)), path, limit=20).collect()
    want = Counter((d, len((t or "").encode()), n := len(sp.encode(t or "")), n > 20) for d, t in rows)
    assert Counter(tuple(r) for r in got) == want
    assert token_counts.token_counts(frame(spark, []), path).count() == 0


def test_packing_equals_the_library(spark):
    from tokenizers import Tokenizer

    path = queries.tokenizer("byte_bpe_50k.json")
    coder = Tokenizer.from_file(path)
    rows = [(i, t) for i, t in enumerate(fuzz(600, 5))] + [(d, t) for d, t, _ in ODD]
    placed = packing.pack_documents(clash(frame(spark, rows)), path, capacity=64, with_ids=True).cache()
    want = Counter()
    for d, t in rows:
        ids = coder.encode(t or "", add_special_tokens=False).ids + [2]
        head = (len(ids) - 1) % 64 + 1
        cuts = [0, *range(head, len(ids) + 1, 64)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[d, k, a, b - a, zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[a:b]))] += 1
    got = placed.collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 64
    counts = Counter(r.length for r in got)
    assert bin_completion.lower_bound(counts, 64) <= len(bins) <= sum(n for _, n in bin_completion.best_fit(dict(counts), 64))
    whole = packing.sequences(placed).collect()
    assert len(whole) == len(bins) and all(len(r.ids) == 4 * r.n_tokens for r in whole)
    by_place = {(r.sequence_id, r.offset): bytes(r.ids) for r in got}
    for r in whole:
        assert bytes(r.ids) == b"".join(by_place[r.sequence_id, o] for o, _ in sorted(bins[r.sequence_id]))
    assert packing.pack_documents(frame(spark, []), path).count() == 0


def used(solution):
    out = Counter()
    for filling, n in solution:
        for size, each in filling:
            out[size] += each * n
    return out


def test_bin_completion_beats_best_fit():
    counts = {44: 20, 30: 20, 26: 20}
    assert sum(n for _, n in bin_completion.best_fit(counts, 100)) > 20
    best = bin_completion.pack(counts, 100)
    assert sum(n for _, n in best) == 20 and used(best) == Counter(counts)


@pytest.mark.parametrize("seed", range(20))
def test_bin_completion_against_exhaustive_search(seed):
    random.seed(seed)
    counts = Counter(random.randint(2, 20) for _ in range(9))
    best = bin_completion.pack(dict(counts), 24)
    assert used(best) == counts and all(sum(s * c for s, c in f) <= 24 for f, _ in best)

    def least(items, rooms, limit):
        if not items:
            return len(rooms)
        if len(rooms) >= limit:
            limit = min(limit, len(rooms))
        out = limit + 1 if len(rooms) >= limit else least(items[1:], [*rooms, 24 - items[0]], limit)
        for i, r in enumerate(rooms):
            if r >= items[0] and r not in rooms[:i]:
                out = min(out, least(items[1:], [*rooms[:i], r - items[0], *rooms[i + 1 :]], limit))
        return out

    n = sum(k for _, k in best)
    assert bin_completion.lower_bound(counts, 24) <= n == least(sorted(counts.elements(), reverse=True), [], n)
    assert used(bin_completion.best_fit(dict(counts), 24)) == counts
