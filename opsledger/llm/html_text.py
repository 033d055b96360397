"""Main text of web pages by wrappers that each host's pages have in common.

1. Every page becomes a token stream and, with its repeats folded, a shape. A task counts pages,
   characters, link characters and the fingerprint of the text per (host, shape, slot), so a host
   with a third of all pages is a few rows per task.
2. The distinct shapes of a host are aligned into one wrapper, in buckets of about ``BUCKET``
   shapes and in as many rounds as that takes; buckets go by a hash of the shape and a bucket is
   aligned from its most frequent shape on, so the wrapper does not depend on partitions.
3. Each wrapper slot gets the sums of its shapes' slots. The article is the slots below article
   elements, else below main elements, else below the deepest element around blocks that still holds
   ``SHARE`` of the host's changing text outside links. Slots below elements that are menus,
   headers, footers, sidebars, notices, adverts, forms or comments by tag, role or class are out;
   where no element names the article, text that is the same on all pages is out too.
4. Every page meets its host's wrapper and gives the text of its article slots in page order.

The pages move only if the wrappers are too large to be broadcast; the join then splits a hot
host's pages (adaptive skew join). No page is dropped or cut.

Defined results:
* null or empty html, or a page without an article's text: the empty text, n_chars 0;
* null url or one without ``://``: host is empty; such pages share one wrapper;
* repeated pages, equal ids, null ids: every row is judged alone and kept;
* broken markup: read as far as it goes (see ``page_tokens``); below 96 levels of nesting an
  element belongs to the one above;
* empty table: empty result; other columns are kept, helper columns take names no column has.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsledger.functions.semantics import broadcast_if_small

from .common import lower_ascii, private, stored
from .page_tokens import read_page
from .wrappers import dump, fold_page, kept_slots, load, matched, merged, slots

#: Shapes that one alignment takes in on average.
BUCKET = 48
#: Share of a host's changing text that the article's element holds, where no element names it.
SHARE = 0.7
#: Pages from which equal text counts as the site's and not as an article's.
LEAST_EQUAL = 3
#: (host, shape, slot) counts that a task holds before it gives them out.
HELD = 200_000
_SEEN = "host string, shape_id long, shape string, slot int, pages long, chars long, links long, low long, high long"
_SLOTS = "host string, slot int, pages long, chars long, links long, low long, high long"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or end, lower-cased; else empty."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)


def _shaped(html: str | None) -> tuple[str, list[str], list[int], list[list[int]]]:
    """Shape of a page, its text runs with their link characters, and the runs of each slot."""
    root, texts, links = read_page(html)
    root = fold_page(root)
    return dump(root), texts, links, [s.marks for s, _ in slots(root)]


def _seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts per (host, shape, slot) of a task's pages."""
    total: dict[tuple[str, str], list[list[int]]] = {}
    held = 0

    def given() -> pd.DataFrame:
        rows = [(host, _hash(shape), None if k else shape, k, *s) for (host, shape), all_ in total.items() for k, s in enumerate(all_)]
        return pd.DataFrame(rows, columns=[c.split()[0] for c in _SEEN.split(", ")])

    for batch in batches:
        for host, html in zip(batch["host"], batch["html"], strict=True):
            shape, texts, links, runs = _shaped(html)
            sums = total.get((host, shape))
            if sums is None:
                sums = total[host, shape] = [[0, 0, 0, (1 << 63) - 1, -(1 << 63)] for _ in runs]
                held += len(runs)
            for s, own in zip(sums, runs, strict=True):
                text = _hash("\n".join(texts[k] for k in own))
                s[0] += 1
                s[1] += sum(len(texts[k]) for k in own)
                s[2] += sum(links[k] for k in own)
                s[3], s[4] = min(s[3], text), max(s[4], text)
            if held >= HELD:
                yield given()
                total.clear()
                held = 0
    yield given()


def _aligned(group: pd.DataFrame) -> pd.DataFrame:
    """One wrapper of a bucket's shapes, the most frequent first."""
    rows = group.sort_values(["pages", "shape"], ascending=[False, True])
    shape = merged(rows["shape"].tolist())
    return pd.DataFrame([(rows["host"].iloc[0], _hash(shape), shape, int(rows["pages"].sum()))], columns=["host", "shape_id", "shape", "pages"])


def infer_wrappers(shapes: DataFrame) -> DataFrame:
    """One wrapper per host from (host, shape_id, shape, pages), by rounds of aligned buckets."""
    rows = shapes
    while True:
        n = rows.groupBy("host").agg(F.count("*").alias("n"))
        most = n.agg(F.max("n")).first()[0] or 0
        if most <= 1:
            return rows
        buckets = F.ceil(F.col("n") / F.lit(BUCKET)).cast("long")
        spread = rows.join(n, "host").withColumn("bucket", F.pmod(F.xxhash64("shape_id"), buckets))
        rows = stored(spread.groupBy("host", "bucket").applyInPandas(_aligned, "host string, shape_id long, shape string, pages long"), "wrappers")


def _met(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of shapes' slots (rows: shape, wrapper, sums) as counts of wrapper slots."""
    for batch in batches:
        out = []
        for row in batch.itertuples():
            own = matched(row.wrapper, row.shape)
            for s in row.sums:
                if s["slot"] < len(own) and own[s["slot"]] is not None:
                    out.append((row.host, own[s["slot"]], s["pages"], s["chars"], s["links"], s["low"], s["high"]))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in _SLOTS.split(", ")])


def main_slots(wrapper: str, sums: dict[int, tuple[int, int, int, int, int]]) -> list[bool]:
    """Which slots of a wrapper hold the article; sums: pages, chars, links, lowest and highest fingerprint."""
    found = slots(load(wrapper))
    inside = [not any(x[:1] == "!" for x in path) for _, path in found]
    for root in "*+":
        named = [ok and any(x[:1] == root for x in path) for ok, (_, path) in zip(inside, found, strict=True)]
        if any(named):
            return named
    none = (0, 0, 0, 0, 0)
    pages = max((s[0] for s in sums.values()), default=0)
    equal = [sums.get(k, none)[0] >= LEAST_EQUAL and sums[k][3] == sums[k][4] for k in range(len(found))]
    linked = [2 * sums.get(k, none)[2] >= max(sums.get(k, none)[1], 1) for k in range(len(found))]
    open_ = [ok and not (same and pages >= LEAST_EQUAL) and not link for ok, same, link in zip(inside, equal, linked, strict=True)]
    weight = [sums.get(k, none)[1] * ok for k, ok in enumerate(open_)]
    region, depth = list(range(len(found))), 0
    while True:
        below: dict[str, list[int]] = {}
        for k in region:
            if len(found[k][1]) > depth:
                below.setdefault(found[k][1][depth], []).append(k)
        best = max(below.values(), key=lambda ks: sum(weight[k] for k in ks), default=[])
        mass = sum(weight[k] for k in best)
        block = any(len(found[k][1]) == depth + 1 for k in best)  # text right below it: a block, not a container
        if not mass or block or mass < SHARE * sum(weight[k] for k in region):
            return [ok and k in set(region) for k, ok in enumerate(open_)]
        region, depth = best, depth + 1


def _judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Wrappers (host, wrapper, sums of its slots) with a mark per slot that belongs to the article."""
    for batch in batches:
        keep = []
        for row in batch.itertuples():
            sums = {s["slot"]: (s["pages"], s["chars"], s["links"], s["low"], s["high"]) for s in (row.sums if row.sums is not None else ())}
            keep.append("".join("01"[k] for k in main_slots(row.wrapper, sums)))
        yield pd.DataFrame({"host": batch["host"], "wrapper": batch["wrapper"], "keep": keep})


def host_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host, wrapper, keep (a 0 or 1 per text slot) of every host that has a page with text."""
    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html")).where("html IS NOT NULL")
    seen = rows.mapInPandas(_seen, _SEEN).groupBy("host", "shape_id", "slot")
    seen = seen.agg(F.max("shape").alias("shape"), *(F.sum(c).alias(c) for c in ("pages", "chars", "links")), F.min("low").alias("low"), F.max("high").alias("high"))
    sums = F.collect_list(F.struct("slot", "pages", "chars", "links", "low", "high")).alias("sums")
    shapes = stored(seen.groupBy("host", "shape_id").agg(F.max("shape").alias("shape"), F.max("pages").alias("pages"), sums), "shapes")
    wrappers = infer_wrappers(shapes.select("host", "shape_id", "shape", "pages")).select("host", F.col("shape").alias("wrapper"))
    met = shapes.select("host", "shape", "sums").join(wrappers, "host").mapInPandas(_met, _SLOTS).groupBy("host", "slot")
    met = met.agg(*(F.sum(c).alias(c) for c in ("pages", "chars", "links")), F.min("low").alias("low"), F.max("high").alias("high"))
    totals = met.groupBy("host").agg(F.collect_list(F.struct("slot", "pages", "chars", "links", "low", "high")).alias("sums"))
    return stored(wrappers.join(totals, "host", "left").mapInPandas(_judged, "host string, wrapper string, keep string"), "host-wrappers")


def _extractor():
    """Main text of pages (html, wrapper, keep); the slots of a (wrapper, shape) are found once per task."""

    def extract(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        known: dict[tuple[str, str], list[bool]] = {}
        for htmls, wrappers, keeps in batches:
            out = []
            for html, wrapper, keep in zip(htmls, wrappers, keeps, strict=True):
                if html is None or wrapper is None:
                    out.append("")
                    continue
                shape, texts, _, runs = _shaped(html)
                own = known.get((wrapper, shape))
                if own is None:
                    if len(known) >= 10_000:
                        known.clear()
                    own = known[wrapper, shape] = kept_slots(wrapper, keep, shape)
                wanted = sorted(k for kept, ks in zip(own, runs, strict=True) if kept for k in ks)
                out.append("\n".join(texts[k] for k in wanted))
            yield pd.Series(out, dtype=object)

    return extract


def main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Every row with text (its article) and n_chars (code points); html is not kept."""
    own = private(pages)
    wrappers = host_wrappers(pages, url_col, html_col)
    names = {"host": f"{own}host", "wrapper": f"{own}wrapper", "keep": f"{own}keep"}
    wrappers = wrappers.select(*(F.col(a).alias(b) for a, b in names.items()))
    rows = pages.withColumn(names["host"], host_of(F.col(url_col))).join(broadcast_if_small(wrappers), names["host"], "left")
    extract = F.pandas_udf(_extractor(), "string")
    kept = [c for c in pages.columns if c.lower() not in ("text", "n_chars", html_col.lower())]
    out = rows.select(*kept, extract(F.col(html_col), F.col(names["wrapper"]), F.col(names["keep"])).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
