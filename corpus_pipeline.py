"""A corpus pipeline of five stages, each an operator of ``opsledger.llm``.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the
last return the columns of ``documents``, whatever further columns their input has. Long texts are
handled whole and an empty table gives an empty one. Decisions go by doc_id, which identifies a document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsledger.llm import common, line_dedup, mixing, ngram_join, packing, queries, toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(rows: DataFrame) -> DataFrame:
    """The columns of documents, with the length of the text as it now is."""
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject.

    Null and empty texts are judged as texts without words; null ids and repeated rows are judged
    like others. Without labels of both kinds nothing is rejected.
    """
    return _documents(toxicity.keep_clean(docs, queries.table(spark, sf_dir, "labels")))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source.

    All rows stay. A null source is one like others; null texts stay null, empty ones empty, and
    repeated rows get the same text.
    """
    return _documents(line_dedup.drop_boilerplate(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id.

    Five-word shingles, Jaccard 0.8. Repeated rows of the kept id stay one row. Null, empty and
    white texts are alone in their groups and stay. A row without an id stays, as nothing names it
    as lost, and never stands for a group.
    """
    docs = docs.select(*COLUMNS)
    classes = common.stored(ngram_join.jaccard_classes(docs, words=5, percent=80), "classes")
    lost = classes.where("component_id IS NOT NULL AND doc_id <> component_id").select("doc_id").distinct()
    kept = docs.join(lost, "doc_id", "left_anti")
    repeated = classes.where("doc_id IS NOT NULL").groupBy("doc_id").count().where(F.col("count") > 1).select("doc_id")
    once = kept.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(*(F.first(c).alias(c) for c in COLUMNS[1:]))
    return _documents(kept.join(repeated, "doc_id", "left_anti").unionByName(once))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources weighted 1, 2, 3: a row for each copy of a document that it takes."""
    return _documents(mixing.mixed_documents(mixing.mix_sources(docs, (1, 2, 3), 3.0)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 1024 tokens."""
    return packing.pack_documents(docs, queries.tokenizer("byte_bpe_50k.json"), 1024, 2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_copies", drop_near_copies),
    ("source_mix", mix_sources),
    ("packing", pack),
]

#: No SQL: trained models, components over similarity links and the packing search.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written and read again by the next."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
