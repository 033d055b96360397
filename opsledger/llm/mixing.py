"""Mixing sources to target weights with exact budgets, in DataFrame functions only.

A document's place in its source is a hash of its id, so equal ranges of the key space hold
about equally many documents: the key's range is its bucket, rows are ordered inside buckets,
and token counts are summed per bucket and then over the buckets of a source. A source's budget
is whole epochs plus a rest; the rest ends at one key, its cut. The cuts (one row per source)
decide about every document where it lies: no document is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import GAP, private, stored, word_count

#: Documents per bucket, about; a bucket is sorted in one task.
BUCKET_ROWS = 100_000
KEY_BITS = 60


def hash_key(doc_id: Column, seed: str = "mix") -> Column:
    """Uniform 60-bit key of an id (null has one too)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """Number the sources by code point, null last, by counting over range partitions."""
    order = [F.col("source").isNull(), F.col("source")]
    dealt = stored(sources.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = dealt.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return dealt.join(F.broadcast(offsets), "part").withColumn("rank", F.col("base") + inside - 1).drop("part", "base")


def targets(sources: DataFrame, weights: tuple[float, ...], most: float) -> DataFrame:
    """Add each source's target to (source, source_size).

    Weights repeat over the sources by code point. Targets share the whole size by weight, stop
    at ``most`` times the source's size, and what is cut off is shared again by weight. The level
    per weight at which nothing more is cut off is found by one small sum per round.
    """
    table = F.array(*(F.lit(float(w)) for w in weights))
    ranked = _ranked(sources).withColumn("weight", F.element_at(table, (F.col("rank") % len(weights) + 1).cast("int")))
    ranked = stored(ranked.withColumn("cap", most * F.col("source_size")).drop("rank"), "weights")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level = None
    while True:
        is_full = F.lit(False) if level is None else F.col("weight") * level >= F.col("cap")
        full, free = ranked.agg(F.sum(F.when(is_full, F.col("cap")).otherwise(0.0)), F.sum(F.when(is_full, 0.0).otherwise(F.col("weight")))).first()
        if not free:
            return ranked.withColumn("target", F.col("cap").cast("double")).drop("cap")
        now = (total - full) / free
        if level is not None and now <= level:
            return ranked.withColumn("target", F.least(F.col("cap"), F.col("weight") * F.lit(level)).cast("double")).drop("cap")
        level = now


def cuts(sized: DataFrame, weights: tuple[float, ...], most: float) -> DataFrame:
    """One row per source: source_size, target, epochs, cut_key, cut_words, cut_size.

    ``sized`` has source, key, size. A document with a key below the cut is taken once more than
    ``epochs``; documents at the cut share ``cut_words`` in proportion to their sizes, which
    sum to ``cut_size``.
    """
    n = sized.count()
    buckets = max(1, -(-n // BUCKET_ROWS))
    bucket = F.floor(F.col("key") / F.lit(float(1 << KEY_BITS)) * buckets)
    # Rows of one key are one entry: repeated rows cannot make a bucket hot.
    keyed = sized.groupBy("source", "key").agg(F.sum("size").alias("size")).withColumn("bucket", bucket)
    keyed = stored(keyed, "keys")
    per_bucket = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("size"))
    plan = targets(per_bucket.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    goal = F.floor(F.col("target"))
    plan = plan.withColumn("goal", goal).withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("goal div source_size")).otherwise(0))
    plan = stored(plan.withColumn("rest", F.col("goal") - F.col("epochs") * F.col("source_size")), "plan")
    up_to = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    sums = per_bucket.withColumn("end", F.sum("size").over(up_to)).withColumnRenamed("source", "s")
    at = plan.where("rest > 0").join(sums, F.col("source").eqNullSafe(F.col("s"))).where("rest < end AND rest >= end - size")
    at = at.select("source", "bucket", (F.col("rest") - (F.col("end") - F.col("size"))).alias("inside"))
    inner = at.join(keyed.select(F.col("source").alias("s"), F.col("bucket").alias("b"), "key", "size"), F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    so_far = F.sum("size").over(Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, 0))
    cut = inner.withColumn("end", so_far).where("inside < end AND inside >= end - size")
    cut = cut.select(F.col("source").alias("s"), F.col("key").alias("cut_key"), (F.col("inside") - (F.col("end") - F.col("size"))).alias("cut_words"), F.col("size").alias("cut_size"))
    out = plan.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").select("source", "source_size", "target", "epochs", F.coalesce("cut_key", F.lit(-1).cast("long")).alias("cut_key"), F.coalesce("cut_words", F.lit(0).cast("long")).alias("cut_words"), F.coalesce("cut_size", F.lit(1).cast("long")).alias("cut_size"))
    return stored(out, "cuts")


#: Sources up to which the table of cuts (below 100 bytes a row) is broadcast.
BROADCAST_SOURCES = 100_000


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0, seed: str = "mix") -> DataFrame:
    """Decide how many words a mix takes from every document.

    ``docs`` has doc_id, text, source; further columns stay. Adds size (words; null text: 0),
    source_size, target (of its source) and taken: whole copies of the document, one more below
    the source's cut, and a part of it at the cut, so that a source's taken words are its target
    rounded down (at most as many words fewer as equal ids meet at the cut). Nothing is random:
    reruns agree. Null is a source of its own, after all others. Null ids and repeated rows
    are documents like others; rows with one id and source share their fate. An empty table
    gives no rows. Columns named like an added one are replaced.
    """
    p = private(docs)
    base = docs.withColumns({"size": word_count(F.col("text")), f"{p}key": hash_key(F.col("doc_id"), seed)})
    plan = cuts(base.select("source", F.col(f"{p}key").alias("key"), "size"), weights, most)
    plan = plan.select(*(F.col(c).alias(f"{p}{c}") for c in plan.columns))
    if plan.count() <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    out = base.join(plan, F.col("source").eqNullSafe(F.col(f"{p}source")))
    part = F.expr(f"size * {p}cut_words div greatest({p}cut_size, 1)")
    extra = F.when(F.col(f"{p}key") < F.col(f"{p}cut_key"), F.col("size")).when(F.col(f"{p}key") == F.col(f"{p}cut_key"), part).otherwise(0)
    out = out.withColumns({"source_size": F.col(f"{p}source_size"), "target": F.col(f"{p}target"), "taken": (F.col(f"{p}epochs") * F.col("size") + extra).cast("long")})
    return out.drop(*(c for c in out.columns if c.startswith(p)))


def mixed_documents(mixed: DataFrame, text: str = "text") -> DataFrame:
    """The mix itself: a row per copy taken; at a cut the last copy ends after its budget.

    Needs size and taken of :func:`mix_sources`. Documents without words are kept once, as they
    take nothing from any budget.
    """
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.greatest(F.col("size"), F.lit(1)))).otherwise(1).cast("int")
    rest = F.when(F.col("size") > 0, F.col("taken") % F.greatest(F.col("size"), F.lit(1))).otherwise(0).cast("int")
    copies = F.concat(F.array_repeat(F.lit(-1), whole), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>")))
    words = f"{private(mixed)}words"
    rows = mixed.withColumn(words, F.explode(copies))
    head = F.array_join(F.slice(F.split(F.regexp_replace(F.col(text), f"^[{GAP}]+", ""), f"[{GAP}]+"), 1, F.greatest(F.col(words), F.lit(1))), " ")
    return rows.withColumn(text, F.when(F.col(words) < 0, F.col(text)).otherwise(head)).drop(words)
