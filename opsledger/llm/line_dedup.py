"""Line deduplication by site-relative frequency, in DataFrame functions.

A line is boilerplate of a host when it stands on more than a given share of the host's pages and
on some pages at least: one rule for hosts of every size, without a size from which it holds.
Pages with equal text count once, so copies of a page do not turn its content into boilerplate.
Lines are counted by a 64-bit hash first; only the few hashes above the share are counted
again with their real text, so a chance collision removes nothing.

``drop_site_lines`` is the stricter rule, where pages that share most of their lines vote once, so
a cluster of near copies keeps its own text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import private, stored
from .ngram_join import jaccard_classes

#: Boilerplate lines up to which the table per host is broadcast.
BROADCAST_LINES = 200_000


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(pages: DataFrame, ratio: float, least_pages: int) -> DataFrame:
    """host, line, n_pages, host_pages of the lines above the share on ``least_pages`` or more.

    ``pages`` has host and text. Blank lines are none. Counts are summed before every shuffle.
    """
    seen = pages.where(F.col("text").isNotNull()).select("host", F.xxhash64("text").alias("page"), "text")
    totals = seen.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("host_pages"))
    totals = stored(totals, "hosts")
    lines = seen.select("host", "page", F.explode(F.array_distinct(F.transform(_lines(F.col("text")), lambda x: F.xxhash64(_trimmed(x))))).alias("line"))
    counted = lines.distinct().groupBy("host", "line").agg(F.count("*").alias("n"))
    often = counted.join(totals.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h"))).where((F.col("n") >= least_pages) & (F.col("n") > ratio * F.col("host_pages")))
    often = stored(often.select(F.col("host").alias("h"), F.col("line").alias("hash"), "host_pages"), "often")
    if often.count() <= BROADCAST_LINES:
        often = F.broadcast(often)
    texts = seen.select("host", "page", F.explode(F.array_distinct(F.transform(_lines(F.col("text")), _trimmed))).alias("line")).where("line <> ''")
    hits = texts.join(often, F.col("host").eqNullSafe(F.col("h")) & (F.xxhash64("line") == F.col("hash")))
    exact = hits.select("host", "line", "page", "host_pages").distinct().groupBy("host", "line", "host_pages").agg(F.count("*").alias("n_pages"))
    return exact.where((F.col("n_pages") >= least_pages) & (F.col("n_pages") > ratio * F.col("host_pages"))).select("host", "line", "n_pages", "host_pages")


def _without(pages: DataFrame, lines: DataFrame, host: str, text: str) -> DataFrame:
    """Pages without the listed (host, line), and n_lines, n_dropped."""
    p = private(pages)
    per_host = lines.groupBy(F.col("host").alias(f"{p}host")).agg(F.collect_set("line").alias(f"{p}lines"))
    if lines.count() <= BROADCAST_LINES:
        per_host = F.broadcast(per_host)
    joined = pages.join(per_host, F.col(host).eqNullSafe(F.col(f"{p}host")), "left")
    split = _lines(F.col(text))
    kept = F.filter(split, lambda x: ~F.array_contains(F.col(f"{p}lines"), _trimmed(x)))
    out = joined.withColumn(f"{p}kept", F.when(F.col(f"{p}lines").isNull(), split).otherwise(kept))
    n = F.when(F.col(text).isNull(), 0).otherwise(F.size(split)).cast("long")
    left = F.when(F.col(text).isNull(), 0).otherwise(F.size(f"{p}kept")).cast("long")
    out = out.withColumns({"n_lines": n, "n_dropped": n - left})
    return out.withColumn(text, F.array_join(f"{p}kept", "\n")).drop(f"{p}host", f"{p}lines", f"{p}kept")


def drop_boilerplate(pages: DataFrame, host: str = "source", text: str = "text", ratio: float = 0.05, least_pages: int = 5) -> DataFrame:
    """Remove from every text the lines on ``least_pages`` pages and more than ``ratio`` of its host's.

    Returns all columns with the shorter text, and n_lines, n_dropped. Lines compare without
    white space at their ends; all their copies on a page go. Blank lines stay. Null is a host
    like others; a null text stays null with 0 lines; an empty one has one blank line. Repeated
    rows get the same result. Very long texts are handled whole. An empty table gives no rows;
    columns named like an added one are replaced.

    A host has at most (mean lines of a page / ratio) boilerplate lines, so its list is a bounded
    array; it is joined to the pages by host, by broadcast only below a checked number of lines.
    """
    lines = stored(boilerplate(pages.select(F.col(host).alias("host"), F.col(text).alias("text")), ratio, least_pages), "boilerplate")
    return _without(pages, lines, host, text)


def site_lines(pages: DataFrame, ratio: float, least_votes: int, alike: int) -> DataFrame:
    """host, line, n_votes, host_votes of the lines with enough votes, at every size of a host.

    ``pages`` has host and text. Pages of a host whose sets of lines have a Jaccard of ``alike``
    percent or more, directly or through others, are one vote. Blank lines are none.
    """
    seen = pages.where(F.col("text").isNotNull()).select("host", F.xxhash64("text").alias("page"), "text")
    own = F.transform(F.filter(F.transform(_lines(F.col("text")), _trimmed), lambda x: x != ""), lambda x: F.hex(F.xxhash64(F.col("host").isNull(), "host", x)))
    ids = F.xxhash64(F.col("host").isNull(), "host", "page")
    sets = stored(seen.select(ids.alias("doc_id"), "host", "page", F.array_join(F.array_distinct(own), " ").alias("text")).dropDuplicates(["host", "page"]), "sets")
    vote = jaccard_classes(sets, words=1, percent=alike).select("doc_id", F.col("component_id").alias("vote"))
    votes = stored(sets.select("doc_id", "host", "page").join(vote, "doc_id").select(F.col("host").alias("h"), F.col("page").alias("p"), "vote"), "votes")
    totals = votes.groupBy(F.col("h").alias("th")).agg(F.count_distinct("vote").alias("host_votes"))
    on_page = F.col("host").eqNullSafe(F.col("h")) & (F.col("page") == F.col("p"))

    def counted(lines: DataFrame, name: str) -> DataFrame:
        n = lines.join(votes, on_page).select("host", "line", "vote").distinct().groupBy("host", "line").agg(F.count("*").alias(name))
        enough = (F.col(name) >= least_votes) & (F.col(name) > ratio * F.col("host_votes"))
        return n.join(totals, F.col("host").eqNullSafe(F.col("th"))).where(enough).select("host", "line", name, "host_votes")

    hashes = seen.select("host", "page", F.explode(F.array_distinct(F.transform(_lines(F.col("text")), lambda x: F.xxhash64(_trimmed(x))))).alias("line")).distinct()
    often = stored(counted(hashes, "n").select(F.col("host").alias("oh"), F.col("line").alias("hash")), "often")
    if often.count() <= BROADCAST_LINES:
        often = F.broadcast(often)
    texts = seen.select("host", "page", F.explode(F.array_distinct(F.transform(_lines(F.col("text")), _trimmed))).alias("line")).where("line <> ''")
    hits = texts.join(often, F.col("host").eqNullSafe(F.col("oh")) & (F.xxhash64("line") == F.col("hash"))).select("host", "page", "line").distinct()
    return counted(hits, "n_votes")


def drop_site_lines(pages: DataFrame, host: str = "source", text: str = "text", ratio: float = 0.1, least_votes: int = 5, alike: int = 60) -> DataFrame:
    """Remove the lines that have ``least_votes`` votes and more than ``ratio`` of their host's.

    No host is too small to be judged: the least number of votes is all that guards it. A host
    whose pages are mostly boilerplate is one cluster and keeps it. Rows, null and odd texts and
    added columns are as in ``drop_boilerplate``.
    """
    lines = stored(site_lines(pages.select(F.col(host).alias("host"), F.col(text).alias("text")), ratio, least_votes, alike), "boilerplate")
    return _without(pages, lines, host, text)
