"""URL filtering: host rules, then a blocked Bloom filter over listed URLs and an exact join.

All in DataFrame functions. A filter block is four 64-bit words; a canonical URL sets eight bits
of one block, so a probe reads one row. URLs whose block holds all their bits are possible hits;
only these reach the exact hash join with the list, which removes the false positives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, private, stored

#: (verdict, host, path): fits the host and its subdomains if the path begins with ``path``.
Rule = tuple[str, str, str]
WORDS, BLOCK_BITS, BITS_PER_URL = 4, 256, 16
#: Filter blocks (about 60 bytes each) up to which the filter is broadcast.
BROADCAST_BLOCKS = 500_000
#: Query parameters that only track a visit.
TRACKING = ("ref", "fbclid", "gclid", "utm_[^=]*")


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z in lower case; else empty."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host up to ? # or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without a default port, path without trailing /, query without tracking, sorted.

    Scheme and fragment go. Null or a text without :// has no canonical form (null).
    """
    host = F.regexp_replace(host_of(url), ":(80|443)$", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    query = F.regexp_extract(url, r"(?s)^[^#]*?\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^({'|'.join(TRACKING)})(=|$)")))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(F.instr(url, "://") > 0, F.concat(host, path, tail))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Longest fitting rule as (rule, verdict), null if none fits. Rules are a short parameter."""
    rule = verdict = F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def _masks(url: Column) -> list[Column]:
    """The bits of a URL in the words of its block: two in each, from six-bit slices of a hash."""
    h = F.xxhash64(url, F.lit(1))
    one = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * k).bitwiseAND(63).cast("int"))
    return [one(i).bitwiseOR(one(WORDS + i)) for i in range(WORDS)]


def bloom_blocks(listed: DataFrame, blocks: int) -> DataFrame:
    """Blocked Bloom filter of ``listed`` (canonical) as a table: block, w0..w3."""
    masked = listed.select(_block(F.col("canonical"), blocks).alias("block"), *(m.alias(f"w{i}") for i, m in enumerate(_masks(F.col("canonical")))))
    return masked.groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)))


def judge_urls(pages: DataFrame, listed_urls: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """Add host, path, rule and verdict (allow or block) to ``pages``.

    A rule that fits decides, the longest first. Otherwise the page is blocked when its
    canonical URL is that of a row of ``listed_urls`` (url; repeats and nulls allowed). A null
    url or one without :// has empty host and path, fits no rule and is never listed: allow.
    Empty tables give no rows or no blocks. Columns of these names are replaced.

    The filter's size follows the list; it is broadcast only below a checked number of blocks
    and joined by block beyond it. Hits join with the distinct list, so a repeated URL cannot
    multiply rows and adaptive execution may split it.
    """
    listed = stored(listed_urls.select(canonical(F.col("url")).alias("canonical")).where("canonical IS NOT NULL").distinct(), "listed")
    blocks = max(1, -(-listed.count() * BITS_PER_URL // BLOCK_BITS))
    table = bloom_blocks(listed, blocks)
    if blocks <= BROADCAST_BLOCKS:
        table = F.broadcast(table)
    p = private(pages)
    table = table.select(F.col("block").alias(f"{p}block"), F.lit(True).alias(f"{p}ask"), *(F.col(f"w{i}").alias(f"{p}w{i}") for i in range(WORDS)))
    address, known = F.col(url), F.col(f"{p}url")
    judged = pages.withColumns({"host": host_of(address), "path": path_of(address), f"{p}url": canonical(address)})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = judged.withColumns({"rule": rule, f"{p}verdict": verdict})
    # The list only has a say where no rule fits. Other rows keep a spread key that cannot match,
    # so that neither join sends all of them to the task of one null key.
    asked = judged.withColumns({f"{p}ask": F.col("rule").isNull() & known.isNotNull(), f"{p}block": _block(F.coalesce(known, address), blocks)})
    probed = asked.join(table, [f"{p}block", f"{p}ask"], "left")
    held = F.lit(True)
    for i, m in enumerate(_masks(known)):
        held = held & (F.col(f"{p}w{i}").bitwiseAND(m) == m)
    probed = probed.withColumns({f"{p}maybe": F.coalesce(held, F.lit(False)), f"{p}url": F.coalesce(known, address)})
    exact = listed.select(F.col("canonical").alias(f"{p}url"), F.lit(True).alias(f"{p}maybe"), F.lit(True).alias(f"{p}hit"))
    out = probed.join(exact, [f"{p}url", f"{p}maybe"], "left")
    out = out.withColumn("verdict", F.coalesce(f"{p}verdict", F.when(F.col(f"{p}hit"), "block").otherwise("allow")))
    return out.drop(*(c for c in out.columns if c.startswith(p)))
