"""Registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ball_kmeans, fill_in_middle, html_text, line_dedup, mixing, near_vectors, ngram_join, packing, quality, token_counts, topk, toxicity, url_filter


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Place of a public vocabulary file (the package that ships them is not ours)."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


#: Host rules of the URL query: (verdict, host, path prefix).
RULES: list[url_filter.Rule] = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
#: Pages whose text names one of these list their URL.
FLAGGED = "idiot|moron|scum|loser|clown|trash"


def op1_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Words that a mix with source weights 1, 2, 3 takes from every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return mixing.mix_sources(docs, (1, 2, 3), 3.0).select("doc_id", "size", "source_size", "target", "taken")


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every page's URL: host rules, else whether a flagged page has the URL."""
    pages = table(spark, folder, "pages")
    flagged = pages.where(F.lower("html").rlike(f"(^|[^a-z])({FLAGGED})([^a-z]|$)")).select("url")
    return url_filter.judge_urls(pages.select("page_id", "url"), flagged, RULES).select("page_id", "host", "path", "rule", "verdict")


def op3_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate embeddings of one label at cosine 0.98."""
    return near_vectors.near_vectors(table(spark, folder, "embeddings").select("vec_id", "embedding", "label"), 0.98)


def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as sequences of at most 1024 tokens."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, tokenizer("byte_bpe_50k.json"), 1024, 2)


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document."""
    return quality.score_quality(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels"))


def op6_top_inner_products(spark: SparkSession, folder: str) -> DataFrame:
    """Five best rows for every embedding whose id is divisible by 50."""
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, 5, 256)


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Category probabilities and verdict of every document."""
    return toxicity.judge_toxicity(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels"))


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that each document keeps, its source as the site."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    out = line_dedup.drop_boilerplate(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.length("text").cast("long").alias("kept_chars"), F.md5(F.col("text").cast("binary")).alias("kept_md5"))


def op8_site_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that each document keeps when small sources count and near copies vote once."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    out = line_dedup.drop_site_lines(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.length("text").cast("long").alias("kept_chars"), F.md5(F.col("text").cast("binary")).alias("kept_md5"))


def op9_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Classes of documents whose sets of four-word shingles have a Jaccard of 0.85 or more."""
    return ngram_join.jaccard_classes(table(spark, folder, "documents").select("doc_id", "text"), words=4, percent=85)


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, tokenizer("piece_bpe_32k.model"), 4096)


def op11_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page, by the wrapper of its host."""
    return html_text.main_text(table(spark, folder, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Codes of four bytes for every usable embedding."""
    return ball_kmeans.vector_codes(table(spark, folder, "embeddings").select("vec_id", "embedding", "label"))


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in its fill-in-middle form, as fingerprints."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return fill_in_middle.digests(docs).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_source_mix, op2_url_filter, op3_embedding_near_dedup, op4_best_fit_packing, op5_quality, op6_top_inner_products, op7_toxicity, op8_line_dedup, op8_site_lines, op9_ngram_jaccard_join, op10_token_counts, op11_html_text, op12_vector_codes, op13_fill_in_middle)
}

_WORDS = "length(regexp_replace(regexp_replace(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+', 'x', 'g'), '[\\x20\\x09-\\x0D]+', '', 'g'))"

_OP1 = f"""
WITH d AS (
  SELECT doc_id, source, {_WORDS}::BIGINT AS size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS k
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w
  FROM d GROUP BY source
), levels AS (  -- level when exactly the sources of a smaller or equal cap per weight are full
  SELECT 3.0 * source_size / w AS r, (SELECT sum(source_size) FROM s) AS total,
         (SELECT sum(x.w) FROM s x WHERE 3.0 * x.source_size / x.w > 3.0 * s.source_size / s.w) AS free,
         (SELECT sum(3.0 * x.source_size) FROM s x WHERE 3.0 * x.source_size / x.w <= 3.0 * s.source_size / s.w) AS full_caps,
         (SELECT min(3.0 * x.source_size / x.w) FROM s x WHERE 3.0 * x.source_size / x.w > 3.0 * s.source_size / s.w) AS next_r
  FROM s
  UNION ALL SELECT 0, sum(source_size), sum(w), 0, min(3.0 * source_size / w) FROM s
), level AS (SELECT min((total - full_caps) / free) AS v FROM levels WHERE free > 0 AND (total - full_caps) / free >= r AND (total - full_caps) / free <= next_r),
t AS (
  SELECT source, source_size, least(3.0 * source_size, w * (SELECT v FROM level))::DOUBLE AS target FROM s
), g AS (
  SELECT *, floor(target)::BIGINT AS goal, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs FROM t
), c AS (
  SELECT source, k, sum(size) AS size, sum(sum(size)) OVER (PARTITION BY source ORDER BY k) AS upto FROM d GROUP BY source, k
)
SELECT d.doc_id, d.size, g.source_size, g.target,
       (g.epochs * d.size + CASE WHEN c.upto <= g.goal - g.epochs * g.source_size THEN d.size
             WHEN c.upto - c.size < g.goal - g.epochs * g.source_size
             THEN d.size * (g.goal - g.epochs * g.source_size - (c.upto - c.size)) // greatest(c.size, 1) ELSE 0 END)::BIGINT AS taken
FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source JOIN c ON d.source IS NOT DISTINCT FROM c.source AND d.k = c.k
"""

_TRACK = "|".join(url_filter.TRACKING)
_OP2 = f"""
WITH p AS (
  SELECT page_id, html, url, coalesce(instr(url, '://'), 0) AS i,
         substr(url, instr(url, '://') + 3) AS rest FROM pages
), q AS (
  SELECT page_id, html, i,
         CASE WHEN i > 0 THEN translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN i > 0 THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path,
         list_sort(list_filter(string_split(regexp_extract(url, '^[^#]*?\\?([^#]*)', 1), '&'),
                   lambda x: x <> '' AND NOT regexp_matches(x, '^({_TRACK})(=|$)'))) AS args
  FROM p
), u AS (
  SELECT *, CASE WHEN i > 0 THEN regexp_replace(host, ':(80|443)$', '') || regexp_replace(path, '/+$', '')
         || CASE WHEN len(args) > 0 THEN '?' || array_to_string(args, '&') ELSE '' END END AS canonical FROM q
), listed AS (
  SELECT DISTINCT canonical FROM u WHERE regexp_matches(lower(html), '(^|[^a-z])({FLAGGED})([^a-z]|$)')
), r(kind, rhost, rpath) AS (VALUES {', '.join(repr(x) for x in RULES)}
), best AS (
  SELECT page_id, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(kind, length(rhost || rpath)) AS kind
  FROM u JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id
)
SELECT u.page_id, host, path, rule,
       coalesce(kind, CASE WHEN canonical IN (SELECT canonical FROM listed WHERE canonical IS NOT NULL) THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN best USING (page_id)
"""

_OP3 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
), pairs AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98
), reach(x, y) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.x, p.y FROM reach r JOIN pairs p ON r.y = p.x)
SELECT v.vec_id, (SELECT count(*) FROM pairs WHERE x = v.vec_id)::BIGINT AS n_links,
       (SELECT min(y) FROM reach WHERE x = v.vec_id) AS component_id,
       (SELECT min(y) FROM reach WHERE x = v.vec_id) = v.vec_id AS kept
FROM v
"""

_OP6 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, n::INTEGER AS rank, vec_id, score FROM r WHERE n <= 5
"""

_TRIM = "trim(x, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
_OP8 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
n AS (SELECT source, count(DISTINCT text) AS pages FROM d GROUP BY source),
l AS (SELECT DISTINCT source, text, unnest(list_transform(lines, lambda x: {_TRIM})) AS line FROM d),
b AS (
  SELECT l.source, line FROM l JOIN n ON l.source IS NOT DISTINCT FROM n.source WHERE line <> ''
  GROUP BY l.source, line, pages HAVING count(DISTINCT text) >= 5 AND count(DISTINCT text) > 0.05 * pages
), o AS (SELECT source, list(line) AS bad FROM b GROUP BY source),
k AS (SELECT r, doc_id, text, lines, list_filter(lines, lambda x: NOT list_contains(coalesce(bad, []), {_TRIM})) AS kept
      FROM d LEFT JOIN o ON d.source IS NOT DISTINCT FROM o.source)
SELECT doc_id, coalesce(len(lines), 0)::BIGINT AS n_lines, coalesce(len(lines) - len(kept), 0)::BIGINT AS n_dropped,
       CASE WHEN text IS NOT NULL THEN length(coalesce(array_to_string(kept, chr(10)), '')) END::BIGINT AS kept_chars,
       CASE WHEN text IS NOT NULL THEN md5(coalesce(array_to_string(kept, chr(10)), '')) END AS kept_md5
FROM k
"""



#: The text of the article element, for pages that have one and whose article holds only blocks and inline markup.
_OP11 = r"""
WITH a AS (
  SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '<article[^>]*>(.*?)</article>', 1, 's'), '\s+', ' ', 'g') AS body FROM pages
), b AS (
  SELECT page_id, url, string_split(regexp_replace(regexp_replace(regexp_replace(body, '</?(p|h[1-6]|div|ul|ol|li|section|blockquote)( [^>]*)?>', chr(10), 'g'), '<br */?>', ' ', 'g'), '<[^>]*>', '', 'g'), chr(10)) AS blocks FROM a
), c AS (
  SELECT page_id, url, list_transform(blocks, lambda x: trim(regexp_replace(regexp_replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(x,
    '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&#39;', chr(39)), '&#x27;', chr(39)), '&apos;', chr(39)), '&nbsp;', ' '), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS blocks FROM b
), d AS (SELECT page_id, url, array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10)) AS text FROM c)
SELECT page_id, url, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n_chars FROM d
"""


def _op12() -> str:
    """Plain rounds of all distances, one pair of steps per round."""
    steps = [
        """v AS MATERIALIZED (
  SELECT vec_id, label, p, list_transform(embedding[p * len(embedding) // 4 + 1 : (p + 1) * len(embedding) // 4], lambda x: floor(1024 * x::DOUBLE)) AS e
  FROM embeddings, (SELECT unnest(range(4)) AS p)
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        "c0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS i, e FROM v QUALIFY i < 256)",
    ]
    for k in range(5):
        steps.append(f"""a{k} AS MATERIALIZED (
  SELECT vec_id, any_value(v.label) AS label, v.p, any_value(v.e) AS e, min({{'d': list_dot_product(v.e, v.e) - 2 * list_dot_product(v.e, c.e) + list_dot_product(c.e, c.e), 'i': c.i}}) AS best
  FROM v JOIN c{k} c ON v.p = c.p GROUP BY vec_id, v.p
)""")
        if k < 4:
            steps.append(f"""m{k} AS (
  SELECT p, i, list(m ORDER BY j) AS e FROM (
    SELECT p, best.i AS i, j, floor(sum(e[j]) / count(*)) AS m FROM a{k}, (SELECT unnest(range(1, (SELECT max(len(e)) FROM v) + 1)) AS j) GROUP BY p, best.i, j
  ) GROUP BY p, i
), c{k + 1} AS MATERIALIZED (SELECT c.p, c.i, coalesce(m.e, c.e) AS e FROM c{k} c LEFT JOIN m{k} m ON c.p = m.p AND c.i = m.i)""")
    return "WITH " + ", ".join(steps) + """, r AS (
  SELECT vec_id, any_value(label) AS label, string_agg(lpad(lower(hex(best.i)), 2, '0'), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM a4 GROUP BY vec_id
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(list_transform(e, lambda x: x::BIGINT::VARCHAR), ','), ',' ORDER BY p, i)) FROM c4) AS codebooks_sha256
FROM r
"""


_OP13 = """
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS x,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines FROM documents
), d AS (
  SELECT *, len(lines) AS n, ('0x' || x[1:8])::BIGINT % (len(lines) + 1) AS h1, ('0x' || x[9:16])::BIGINT % (len(lines) + 1) AS h2,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
              WHEN ('0x' || x[25:32])::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h
), p AS (
  SELECT *, array_to_string(lines[1:least(h1, h2)], '') AS a, array_to_string(lines[least(h1, h2) + 1:greatest(h1, h2)], '') AS b,
         array_to_string(lines[greatest(h1, h2) + 1:n], '') AS c FROM d
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(a) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(b) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || a || '<S>' || c || '<M>' || b ELSE '<S>' || c || '<P>' || a || '<M>' || b END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""

ORACLE: dict[str, str] = {
    "op1_source_mix": _OP1,
    "op2_url_filter": _OP2,
    "op3_embedding_near_dedup": _OP3,
    "op6_top_inner_products": _OP6,
    "op8_line_dedup": _OP8,
    "op11_html_text": _OP11,
    "op12_vector_codes": _op12(),
    "op13_fill_in_middle": _OP13,
}
