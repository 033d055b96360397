"""N-gram Jaccard self-join of documents by a prefix join.

A document's set holds its distinct shingles of ``words`` lower-cased words. Two documents
link when ``100 * |A & B| >= percent * |A | B|``. Any fixed order of shingles gives a right
prefix filter; here shingles follow their 64-bit hash, after those that a bounded sample
shows in many documents (they would open long posting lists and go to the far end).

1. Each document becomes one narrow row: set size, set hash, prefix and a parity sketch, as wide as
   the set is large, whose differing bits bound the symmetric difference from below. Documents
   with equal sets are one class.
2. Classes meet in the posting lists of their prefix shingles. First each class looks, in a few
   of its lists, for the closest sketches among a fixed number of others (rows in proportion to
   classes); these pairs pass a bound on the prefixes and are then verified on the real sets.
3. Verified links give components. All lists are read for pairs of classes that are not in one
   component yet and whose sketches do not keep them apart; they are verified too. A skipped pair
   already lies in one component, so no link that would join two components is lost. A long
   list is dealt in parts to many tasks, and parts of one component do not meet.

Class ids and shingles are 64-bit hashes; a chance collision is the only approximation.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_small_batches, stored
from .components import components

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)
#: Words a task keeps hashed; beyond it the cache starts anew.
CACHE_WORDS = 200_000
#: Stands for a null doc_id inside Python batches, which have no null integers.
NO_ID = -(1 << 63)


class WordHash(dict):
    """Word -> 64-bit hash, filled on demand and bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S33)) * _M1
    x = (x ^ (x >> _S33)) * _M2
    return x ^ (x >> _S33)


def shingle_set(text: bytes | None, words: int, cache: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles.

    Words are runs without \\x20, \\x09-\\x0D; A-Z become lower case. A text with fewer words
    than a shingle has its whole sequence as its only shingle; no words or null: empty.
    """
    found = text.lower().split() if text else ()
    n = len(found)
    if n == 0:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, found), np.uint64, n)
    k = min(words, n)
    x = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        x = mix(x + h[i : n - k + 1 + i])
    return np.unique(x)


def _class_id(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) >> 1


def _hot(tokens: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which tokens fall on a set bit of a bounded table."""
    at = tokens & np.uint64(bits.size * 8 - 1)
    return ((bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1)).astype(bool)


def _prefix(tokens: np.ndarray, percent: int, bits: np.ndarray) -> tuple[np.ndarray, int]:
    """The first shingles in the order, and how many of them are not frequent ones."""
    n = tokens.size
    late = _hot(tokens, bits)
    length = n - (-(-percent * n // 100)) + 1
    return np.concatenate([tokens[~late], tokens[late]])[:length], min(length, n - int(late.sum()))


#: Widths of a sketch in bits: a power of two of about three to six bits per shingle.
LEAST_BITS, MOST_BITS = 256, 4096
#: Pairs compared at once.
CHUNK = 1 << 14


def _sketch(tokens: np.ndarray) -> bytes:
    """Parity of the tokens on each of 256 to 4096 bits, by the size of the set.

    Each differing bit of two sketches of one width is a shingle that one set has alone. Halves of a
    sketch or-ed exclusively are the sketch of half the width.
    """
    m = 1 << int(np.clip(np.ceil(np.log2(3 * tokens.size)), np.log2(LEAST_BITS), np.log2(MOST_BITS)))
    at = np.bincount((tokens >> np.uint64(20)).astype(np.int64) & (m - 1), minlength=m) & 1
    return np.packbits(at.astype(np.uint8)).tobytes()


class Sketches:
    """Sketches of many rows, comparable at the width that two of them share."""

    def __init__(self, rows) -> None:
        self.width = np.array([len(x) // 8 for x in rows], np.int64)
        self.level: dict[int, np.ndarray] = {}
        for w in sorted(set(self.width.tolist()) | {LEAST_BITS // 64}, reverse=True):
            table = np.zeros((len(rows), w), np.uint64)
            for i in np.unique(self.width[self.width >= w]).tolist():
                at = np.flatnonzero(self.width == i)
                x = np.frombuffer(b"".join(rows[j] for j in at.tolist()), np.uint64).reshape(-1, i)
                table[at] = np.bitwise_xor.reduce(x.reshape(-1, i // w, w), axis=1)
            self.level[w] = table

    def _at(self, a: np.ndarray, b: np.ndarray, w: int) -> np.ndarray:
        table = self.level[w]
        parts = [np.bitwise_count(table[a[i : i + CHUNK]] ^ table[b[i : i + CHUNK]]).sum(1, dtype=np.int64) for i in range(0, a.size, CHUNK)]
        return np.concatenate(parts) if parts else np.empty(0, np.int64)

    def within(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Whether rows a and b differ on at most so many bits: at the least width, then at their common one."""
        ok = self._at(a, b, LEAST_BITS // 64) <= most
        common = np.minimum(self.width[a], self.width[b])
        for w in np.unique(common[ok]).tolist():
            at = np.flatnonzero(ok & (common == w))
            ok[at] = self._at(a[at], b[at], w) <= most[at]
        return ok


#: Frequent shingles of a prefix that a posting carries, and the filler behind them.
FIRST, _LAST = 8, np.uint64(2**64 - 1)
_SIGNED = "doc_id long, n long, cid long, prefix binary, early int, sketch binary, first binary"


def _signatures(words: int, percent: int, table):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache, bits = WordHash(), np.frombuffer(table.value, np.uint8)
        for batch in batches:
            out = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                t = shingle_set(text, words, cache)
                if t.size:
                    p, early = _prefix(t, percent, bits)
                    first = np.full(FIRST, _LAST, np.uint64)
                    first[: p.size - early] = p[early : early + FIRST]
                    out.append((doc, t.size, _class_id(t), p.tobytes(), early, _sketch(t), first.tobytes()))
                else:
                    out.append((doc, 0, 0, None, 0, None, None))
            yield pd.DataFrame(out, columns=["doc_id", "n", "cid", "prefix", "early", "sketch", "first"])

    return run


def _sampled_tokens(words: int):
    """Shingles of the lower part of the hash range, where prefixes lie."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = WordHash()
        for batch in batches:
            sets = [t[: np.searchsorted(t, np.uint64(1 << 62))] for x in batch["text"] if (t := shingle_set(x, words, cache)).size]
            if sets:
                yield pd.DataFrame({"token": np.concatenate(sets).view(np.int64)})

    return run


def frequent_table(docs: DataFrame, words: int, share: float, least: int) -> bytes:
    """Bits of shingles that occur in at least ``least`` documents of a sample of a fixed share.

    So the same number of documents makes a shingle frequent at every size. The table has about
    32 bits per document, from 2**16 up to 2**28 in all. It only orders shingles: one
    that is missing or flagged by chance changes no result, only the length of a posting list.
    """
    places = 1 << int(np.clip(np.ceil(np.log2(max(1, docs.count()))) + 5, 16, 28))
    part = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 20)) < int(share * (1 << 20)))
    counted = part.mapInPandas(_sampled_tokens(words), "token long").groupBy("token").count().where(F.col("count") >= least)
    at = F.col("token").bitwiseAND(places - 1)
    one = F.call_function("shiftleft", F.lit(1).cast("int"), at.bitwiseAND(7).cast("int"))
    rows = counted.select(F.shiftright(at, 3).alias("byte"), one.alias("bit")).groupBy("byte").agg(F.bit_or("bit").alias("bits")).toPandas()
    bits = np.zeros(places // 8, np.uint8)
    bits[rows["byte"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).astype(np.uint8)
    return bits.tobytes()


_POSTING = "token long, gid long, n4 long"


def _postings(percent: int):
    """One row per prefix shingle of a class (gid); n4 is four times the set size, plus 1 if the shingle
    is frequent, plus 2 if it lies in the shorter prefix that suffices to meet larger partners."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                tokens = [np.frombuffer(p, np.int64) for p in batch["prefix"]]
                length = np.array([t.size for t in tokens])
                size = batch["n"].to_numpy()
                place = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
                late = place >= np.repeat(batch["early"].to_numpy(), length)
                short = place < np.repeat(size - (-(-2 * percent * size // (100 + percent))) + 1, length)
                yield pd.DataFrame({"token": np.concatenate(tokens), "gid": np.repeat(batch["gid"].to_numpy(), length), "n4": 4 * np.repeat(size, length) + late + 2 * short})

    return run


def _shared_lists(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Drop the postings of lists that hold a single class (rows come sorted by token)."""
    last, twice = None, False  # the row held back, and whether one before it had its token
    for batch in batches:
        if not len(batch):
            continue
        rows = batch if last is None else pd.concat([last, batch])
        token = rows["token"].to_numpy()
        same = token[1:] == token[:-1]
        keep = np.r_[twice, same] | np.r_[same, False]
        last, twice = rows.iloc[-1:], bool(np.r_[twice, same][-1])
        yield rows.iloc[:-1][keep[:-1]]
    if last is not None and twice:
        yield last


#: In about how many of its lists a class looks for partners at first, how far back it looks there,
#: and how many of these are its nearer half.
RECENT, LOOKS, NEARER = 64, 8, 8
_FOLD = ["s0", "s1", "s2", "s3"]
_LOOK = "token long, gid long, n long, s0 long, s1 long, s2 long, s3 long"


def _looks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """About LOOKS prefix shingles of a class with its sketch at the least width.

    The shingle's hash decides, so near copies take much the same ones.
    """
    for batch in batches:
        if len(batch):
            tokens = [np.frombuffer(p, np.uint64) for p in batch["prefix"]]
            length = np.array([t.size for t in tokens])
            token, row = np.concatenate(tokens), np.repeat(np.arange(length.size), length)
            taken = (mix(token) >> np.uint64(32)) * length[row].astype(np.uint64) < np.uint64(LOOKS << 32)
            token, row = token[taken], row[taken]
            fold = Sketches(batch["sketch"].to_list()).level[LEAST_BITS // 64].view(np.int64)[row]
            out = {"token": token.view(np.int64), "gid": batch["gid"].to_numpy()[row], "n": batch["n"].to_numpy()[row]}
            yield pd.DataFrame(out | {c: fold[:, i] for i, c in enumerate(_FOLD)})


def _first_pairs(percent: int):
    """Pair a class with the closest of the few before it in a list and of those further back.

    At most ``2 * LOOKS`` pairs per class or so, however long its lists are; pairs whose sketches
    keep them apart are left out. A list is ordered by size, then by chance, so different
    lists offer different partners, and a cluster of near copies becomes one component although few
    of its pairs are tried.
    """

    def run(batches):
        rows = None
        for batch in batches:
            old = 0 if rows is None else min(len(rows), RECENT)
            rows = batch if rows is None else pd.concat([rows.iloc[-old:], batch])
            token, gid, n = (rows[c].to_numpy() for c in ("token", "gid", "n"))
            fold = np.ascontiguousarray(rows[_FOLD].to_numpy()).view(np.uint64)
            least, partner = np.full((2, len(rows)), MOST_BITS), np.full((2, len(rows)), -1)
            for back in range(1, RECENT + 1):
                i = np.arange(max(old, back), len(rows))
                i = i[token[i] == token[i - back]]
                if not i.size:
                    break
                both = n[i] + n[i - back]
                differ = np.bitwise_count(fold[i] ^ fold[i - back]).sum(1, dtype=np.int64)
                half = int(back > NEARER)
                ok = (differ <= both - 2 * (-(-percent * both // (100 + percent)))) & (differ < least[half, i])
                i, differ = i[ok], differ[ok]
                least[half, i], partner[half, i] = differ, i - back
            half, i = np.nonzero(partner >= 0)
            a, b = gid[partner[half, i]], gid[i]
            if a.size:
                yield pd.DataFrame(np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0), columns=["a", "b"])

    return run


#: Rows of a list that meet in one task; a longer list is cut into parts of about this size.
BLOCK = 2048


def _meetings(rows: DataFrame, percent: int, block: int) -> DataFrame:
    """Deal rows of lists (token, gid, n, comp, own, late, short) to tasks: columns task and side.

    Rows whose own shingles alone keep them apart, and rows without a row of another component
    within a size band of theirs, are left out. A list of at most ``block`` rows is one task, all
    on side 2. A longer one is cut by band, by component where one fills a block, and by salt;
    each two parts that may link are a task, on sides 0 and 1 (a part with itself: 2). Two parts
    of one component never meet. Counts, not rows, say how a list is cut.
    """
    width = max(float(np.log(100 / percent)), 0.01) * 1.001
    rows = rows.where("NOT late").union(rows.where("late").where(100 * (F.col("n") - F.col("own")) >= percent * F.col("n")))
    rows = rows.withColumn("band", F.floor(F.log("n") / width))
    spans = rows.groupBy("token", "band").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    around = spans.select("token", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"), "low", "high")
    met = around.groupBy("token", "band").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low <> high").select("token", "band")
    rows = stored(rows.join(met, ["token", "band"], "left_semi"), "open-lists")
    long = stored(rows.groupBy("token").count().where(F.col("count") > block).select("token"), "long-lists")
    whole = rows.join(long, "token", "left_anti").select("*", F.xxhash64("token").alias("task"), F.lit(2).alias("side"))
    if long.isEmpty():
        return whole.drop("band")
    cut = rows.join(long, "token", "left_semi")
    full = cut.groupBy("token", "band", "comp").count().where(F.col("count") >= block).select("token", "band", "comp", F.lit(True).alias("full"))
    cut = cut.join(full, ["token", "band", "comp"], "left").withColumn("full", F.coalesce("full", F.lit(False)))
    cut = cut.withColumn("kin", F.when(F.col("full"), F.col("comp")).otherwise(0))
    salts = cut.groupBy("token", "band", "full", "kin").agg(F.ceil(F.count("*") / block).alias("salts"))
    salts = stored(salts, "salts")
    named = F.xxhash64("token", "band", "full", "kin", "salt").alias("part")
    cut = cut.join(salts, ["token", "band", "full", "kin"]).withColumn("salt", F.pmod(F.xxhash64("gid"), F.col("salts"))).select(*rows.columns, named)
    parts = salts.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).select("token", "band", "full", "kin", named)
    left, right = (parts.select("token", *(F.col(c).alias(f"{c}{k}") for c in ("band", "full", "kin", "part"))) for k in "ab")
    two = left.join(right, "token").where("parta <= partb AND abs(banda - bandb) <= 1 AND NOT (fulla AND fullb AND kina = kinb)")
    two = two.select("parta", "partb", F.xxhash64("parta", "partb").alias("task"))
    ends = two.select(F.col("parta").alias("part"), "task", F.when(F.col("parta") == F.col("partb"), 2).otherwise(0).alias("side"))
    ends = ends.union(two.where("parta <> partb").select("partb", "task", F.lit(1)))
    return whole.unionByName(cut.join(ends, "part").drop("part")).drop("band")


def _tasks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cut batches sorted by task into frames of whole tasks."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        task = batch["task"].to_numpy()
        cut = int(np.searchsorted(task, task[-1]))
        if held and cut == 0 and held[-1]["task"].iloc[-1] == task[-1]:
            held.append(batch)
            continue
        now = pd.concat([*held, batch.iloc[:cut]])
        held = [batch.iloc[cut:]]
        if len(now):
            yield now
    if held:
        yield pd.concat(held)


def _open_pairs(percent: int, block: int = 512):
    """Pairs of a task that are not in one component yet, by size, own-shingle and sketch bounds.

    ``own`` counts a class's infrequent prefix shingles that no other prefix has. In the list
    of a frequent shingle both prefixes reach the frequent ones, so they hold all their infrequent
    shingles: those that are a class's own are in no partner, whatever its suffix. A pair that
    shares an earlier frequent shingle, among the first ones that postings carry, is left to that
    list. Rows come sorted by task, side and size.
    """

    def run(batches):
        for rows in _tasks(batches):
            task, side, token, gid, comp, n, own = (rows[c].to_numpy() for c in ("task", "side", "token", "gid", "comp", "n", "own"))
            late, short = rows["late"].to_numpy(), rows["short"].to_numpy()
            sketch = Sketches(rows["sketch"].to_list())
            first = np.frombuffer(b"".join(rows["first"]), np.uint64).reshape(-1, FIRST)
            starts = np.flatnonzero(np.r_[True, task[1:] != task[:-1], True])
            found, many = [], 0
            for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist()):
                at, alone = np.arange(lo, hi), side[lo] == 2
                mine, others = (at, at) if alone else (at[side[lo:hi] == 0], at[side[lo:hi] == 1])
                for i in range(0, mine.size, block):
                    p = mine[i : i + block][:, None]
                    for j in range(i if alone else 0, others.size, block):
                        q = others[j : j + block][None, :]
                        if 100 * n[p[-1, 0]] < percent * n[q[0, 0]]:
                            break  # ordered by size: all later ones are too large
                        if 100 * n[q[0, -1]] < percent * n[p[0, 0]]:
                            continue
                        ok = (comp[p] != comp[q]) & (100 * np.minimum(n[p], n[q]) >= percent * np.maximum(n[p], n[q]))
                        ok &= (short[p] & (n[p] <= n[q])) | (short[q] & (n[q] <= n[p]))
                        if alone:
                            ok &= p < q
                        x, y = np.nonzero(ok)
                        a, b = p[x, 0], q[0, y]
                        need = -(-percent * (n[a] + n[b]) // (100 + percent))
                        ok = np.ones(a.size, bool)
                        if late[lo]:
                            ok &= np.minimum(n[a] - own[a], n[b] - own[b]) >= need
                            ok &= n[a] + n[b] - 2 * need >= own[a] + own[b]
                        a, b, need = a[ok], b[ok], need[ok]
                        ok = sketch.within(a, b, n[a] + n[b] - 2 * need)
                        a, b = a[ok], b[ok]
                        if late[lo] and a.size:
                            u, v = first[a][:, :, None], first[b][:, None, :]
                            known = ((u == v) & (u < token[lo : lo + 1].view(np.uint64)[0])).any((1, 2))
                            a, b = a[~known], b[~known]
                        if a.size:
                            turn = (n[a] > n[b]) | ((n[a] == n[b]) & (gid[a] > gid[b]))
                            found.append(np.stack([gid[np.where(turn, b, a)], gid[np.where(turn, a, b)]], 1))
                            many += a.size
                if many > 1 << 18:
                    yield pd.DataFrame(np.unique(np.concatenate(found), axis=0), columns=["a", "b"])
                    found, many = [], 0
            if found:
                yield pd.DataFrame(np.unique(np.concatenate(found), axis=0), columns=["a", "b"])

    return run


def _overlap_reached(both: int, na: int, nb: int, percent: int) -> bool:
    return both > 0 and 100 * both >= percent * (na + nb - both)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct values."""
    at = np.searchsorted(a, b)
    at[at == a.size] = 0
    return int((a[at] == b).sum())


def _by_sets(percent: int):
    def test(a: np.ndarray, na: int, b: np.ndarray, nb: int) -> bool:
        return _overlap_reached(_common(a, b), a.size, b.size, percent)

    return lambda: test


def _by_prefixes(percent: int, table):
    """Upper bound of the overlap: what both prefixes show up to the earlier end, plus the rest."""

    def make():
        bits = np.frombuffer(table.value, np.uint8)

        def upto(x: np.ndarray, late: np.ndarray, end: np.uint64, end_late: bool) -> int:
            early = x.size - int(late.sum())
            return early + int(np.searchsorted(x[early:], end, "right")) if end_late else int(np.searchsorted(x[:early], end, "right"))

        def test(a: np.ndarray, na: int, b: np.ndarray, nb: int) -> bool:
            la, lb = _hot(a, bits), _hot(b, bits)
            if (bool(lb[-1]), int(b[-1])) < (bool(la[-1]), int(a[-1])):
                a, na, la, b, nb, lb = b, nb, lb, a, na, la
            seen = upto(b, lb, a[-1], bool(la[-1]))
            both = _common(np.sort(a), b[:seen]) if seen else 0
            return _overlap_reached(both + min(na - a.size, nb - seen), na, nb, percent)

        return test

    return make


def _tested(make: Callable):
    """Keep the pairs that pass; rows come sorted so that a chunk's centre precedes its others."""

    def run(batches):
        test, at, centre, size = make(), None, None, 0
        for batch in batches:
            out = []
            for chunk, a, b, n, raw in zip(batch["chunk"], batch["a"], batch["b"], batch["n"], batch["tokens"]):
                t = np.frombuffer(raw, np.uint64)
                if b == NO_ID:
                    at, centre, size = (chunk, a), t, n
                elif at != (chunk, a):
                    raise ValueError("a pair came without its centre")
                elif test(centre, size, t, n):
                    out.append((a, b))
            yield pd.DataFrame(np.array(out, np.int64).reshape(-1, 2), columns=["a", "b"])

    return run


def _passing(pairs: DataFrame, tokens: DataFrame, chunk: int, make: Callable) -> DataFrame:
    """Pairs (a, b) that pass a test on ``tokens`` (cid, n, tokens) of both ends.

    Pairs are dealt by centre and chunk; a chunk gets its centre's tokens once and streams the
    others past it, so a task holds one centre at a time and a hub is split into chunks.
    """
    dealt = pairs.withColumn("chunk", F.pmod(F.xxhash64("b"), F.lit(chunk)))
    ends = dealt.select(F.col("b").alias("cid"), "a", "b", "chunk").union(dealt.select("a", "a", F.lit(NO_ID), "chunk").distinct())
    rows = ends.join(tokens, "cid").select("chunk", "a", "b", "n", "tokens")
    return rows.repartition("a", "chunk").sortWithinPartitions("a", "chunk", "b").mapInPandas(_tested(make), "a long, b long")


def _wanted(ids: DataFrame) -> bytes:
    """Table of the ids that pairs need, or-ed together from partial tables.

    It has 8 to 16 bits an id, so about one other text in ten is shingled in vain, from 2**16 up to
    2**28 bits in all; the driver gets it as 64-bit words, 2**22 of them at most.
    """
    log2_bits = int(np.clip(np.ceil(np.log2(max(1, ids.count()))) + 3, 16, 28))

    def part(batches):
        bits = np.zeros((1 << log2_bits) // 8, np.uint8)
        for batch in batches:
            at = mix(batch["doc_id"].to_numpy(np.int64).view(np.uint64)) & np.uint64((1 << log2_bits) - 1)
            np.bitwise_or.at(bits, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        words = bits.view(np.int64)
        at = np.flatnonzero(words)
        yield pd.DataFrame({"at": at, "v": words[at]})

    rows = ids.mapInPandas(part, "at long, v long").groupBy("at").agg(F.bit_or("v").alias("v")).toPandas()
    words = np.zeros((1 << log2_bits) // 64, np.int64)
    words[rows["at"].to_numpy(np.int64)] = rows["v"].to_numpy(np.int64)
    return words.tobytes()


def _sets(words: int, wanted):
    """Real sets of the documents whose bit is set in the table of wanted ids."""

    def run(batches):
        cache, bits = WordHash(), np.frombuffer(wanted.value, np.uint8)
        for batch in batches:
            hit = _hot(mix(batch["doc_id"].to_numpy(np.int64).view(np.uint64)), bits)
            if hit.any():
                sets = [t for x in batch["text"][hit] if (t := shingle_set(x, words, cache)).size]
                yield pd.DataFrame({"cid": np.array([_class_id(t) for t in sets], np.int64), "n": np.array([t.size for t in sets], np.int64), "tokens": [t.tobytes() for t in sets]})

    return run


def _verified(docs: DataFrame, pairs: DataFrame, classes: DataFrame, words: int, percent: int, chunk: int) -> DataFrame:
    """Pairs of classes whose real sets reach the threshold.

    Sets are made again from the texts of only those documents that stand for a class of a
    pair, found through a table of bits (a false hit costs time only).
    """
    ends = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct().join(classes.select("cid", F.col("rep").alias("doc_id")), "cid")
    wanted = docs.sparkSession.sparkContext.broadcast(_wanted(stored(ends.select("doc_id"), "wanted")))
    sets = docs.mapInPandas(_sets(words, wanted), "cid long, n long, tokens binary").groupBy("cid").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"))
    return stored(_passing(pairs, sets, chunk, _by_sets(percent)), "links")


@in_small_batches
def jaccard_classes(docs: DataFrame, words: int = 5, percent: int = 80, share: float = 0.25, least: int = 4, chunk: int = 4) -> DataFrame:
    """Near-duplicate classes of ``docs`` (doc_id, text; other columns are ignored).

    Returns one row per input row: doc_id, n_shingles (set size) and component_id, the smallest
    doc_id of the documents reachable by links (a document always reaches itself). Every row is
    a document, repeated ids included. Only components are computed: pairs already in one are not verified, so neither links nor
    their number are known. Null, empty or white texts have size 0, link with
    nothing and are their own component. A null id takes part, but is never a component_id
    unless nothing else is reached (then null). Very long texts are handled whole. An empty
    table gives no rows. ``share`` and ``least`` only order the shingles.
    """
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.col("text").cast("binary").alias("text"))
    table = docs.sparkSession.sparkContext.broadcast(frequent_table(docs, words, share, least))
    signed = stored(docs.mapInPandas(_signatures(words, percent, table), _SIGNED), "signed")
    one = lambda c: F.first(c).alias(c)

    # Documents with equal sets are a class.
    filled = signed.where("n > 0")
    classes = filled.groupBy("cid").agg(F.max("doc_id").alias("rep"), one("n"), one("prefix"), one("early"), one("sketch"), one("first"))
    classes = stored(classes, "classes")
    units = classes.withColumnRenamed("cid", "gid")
    prefixes = classes.select("cid", "n", F.col("prefix").alias("tokens"))
    near = lambda pairs: _passing(stored(pairs.distinct(), "met"), prefixes, chunk, _by_prefixes(percent, table))

    # First look: each class with the closest of a few others in some of its lists.
    looks = units.select("gid", "n", "prefix", "sketch").mapInPandas(_looks, _LOOK).repartition("token")
    first = looks.sortWithinPartitions("token", "n", F.xxhash64("token", "gid")).mapInPandas(_first_pairs(percent), "a long, b long")
    links = _verified(docs, stored(near(first), "near"), classes, words, percent, chunk)
    reached = components(links)

    # Second look: classes of a list that are not in one component.
    dealt = units.select("gid", "n", "prefix", "early").mapInPandas(_postings(percent), _POSTING).repartition("token").sortWithinPartitions("token")
    lists = stored(dealt.mapInPandas(_shared_lists, _POSTING), "lists")
    met = lists.where("n4 % 2 = 0").groupBy("gid").agg(F.count("*").alias("met"))
    label = units.select("gid", "early").join(reached.withColumnRenamed("node", "gid"), "gid", "left").join(met, "gid", "left")
    label = label.select("gid", F.coalesce("component", "gid").alias("comp"), (F.col("early") - F.coalesce("met", F.lit(0))).alias("own"))
    narrow = lists.join(label, "gid").withColumns({"n": F.shiftright("n4", 2), "late": F.col("n4") % 2 == 1, "short": F.col("n4") % 4 >= 2}).drop("n4")
    again = _meetings(narrow, percent, BLOCK).join(units.select("gid", "sketch", "first"), "gid")
    again = again.repartition("task").sortWithinPartitions("task", "side", "n", "gid")
    between = stored(near(again.mapInPandas(_open_pairs(percent), "a long, b long")), "open")
    if not between.isEmpty():
        reached = components(links.union(_verified(docs, between, classes, words, percent, chunk)))

    # The smallest id of each component goes to its classes, then to their rows.
    named = classes.select("cid").join(reached.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("component", "cid")).select("cid", "root")
    ids = F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))
    per_class = filled.groupBy("cid").agg(F.min(ids).alias("first")).join(named, "cid")
    lowest = per_class.groupBy("root").agg(F.min("first").alias("component_id"))
    final = per_class.select("cid", "root").join(lowest, "root").select("cid", "component_id")
    rows = signed.select(ids.alias("doc_id"), F.col("n").alias("n_shingles"), "cid")
    sized = rows.where("n_shingles > 0").join(final, "cid").select("doc_id", "n_shingles", "component_id")
    return sized.union(rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
