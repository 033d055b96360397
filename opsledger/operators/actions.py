"""Action evidence log as batch operators over append-only status events.

An action's events are ordered by (created_at, event_id).  Ordering-dependent
results (sequence number, previous status) are computed in two levels so a
single very busy action is never one task: rows are first ordered inside
(action, time bucket) groups, and a small per-bucket summary (one row per
action and bucket, bounded by the time span, not by the event volume) carries
counts and the last status across bucket boundaries.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Fixed values of the workflow: allowed next statuses per status.
STATUSES = ("proposed", "approved", "in progress", "completed", "cancelled")
TRANSITIONS = {
    "proposed": ("approved", "cancelled"),
    "approved": ("in progress", "cancelled"),
    "in progress": ("completed", "cancelled"),
    "completed": (),
    "cancelled": (),
}
TERMINAL = ("completed", "cancelled")
# a new revision re-opens an approved / in-progress action as proposed
REOPENABLE = ("approved", "in progress")


def sequenced(events: DataFrame, key: str = "action_id", order: tuple[str, str] = ("created_at", "event_id"),
              bucket: str = "hour") -> DataFrame:
    """Adds ``sequence`` (1-based position in the action), ``previous_status`` and
    ``revision`` (how many proposals the action has had up to and with this event).

    Level 1: row_number / lag inside (key, date_trunc(bucket, ts)).
    Level 2: per (key, bucket) count and last status; a running count and the
    previous bucket's last status over the bucket summary fix up the offsets.
    """
    ts, tie = order
    e = events.withColumn("_b", F.date_trunc(bucket, F.col(ts)))
    inner = Window.partitionBy(key, "_b").orderBy(ts, tie)
    proposed = F.when(F.col("status") == "proposed", 1).otherwise(0)
    e = e.withColumns(
        {"_rn": F.row_number().over(inner), "_prev": F.lag("status").over(inner), "_rev": F.sum(proposed).over(inner)}
    )
    summary = e.groupBy(key, "_b").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(proposed).alias("_p"), F.max_by("status", F.struct(ts, tie)).alias("_last")
    )
    across = Window.partitionBy(key).orderBy("_b")
    summary = summary.select(
        key, "_b",
        F.coalesce(F.sum("_n").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"),
        F.coalesce(F.sum("_p").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.lag("_last").over(across).alias("_prev_bucket_last"),
    )
    out = e.join(summary, [key, "_b"])
    return out.withColumns(
        {
            "sequence": (F.col("_offset") + F.col("_rn")).cast("long"),
            "revision": (F.col("_before") + F.col("_rev")).cast("long"),
            "previous_status": F.when(F.col("_rn") == 1, F.col("_prev_bucket_last")).otherwise(F.col("_prev")),
        }
    ).drop("_b", "_rn", "_prev", "_rev", "_offset", "_before", "_prev_bucket_last")


def _allowed(prev: F.Column, nxt: F.Column) -> F.Column:
    cases = None
    for s, nexts in TRANSITIONS.items():
        ok = list(nexts) + (["proposed"] if s in REOPENABLE else [])
        cond = nxt.isin(ok) if ok else F.lit(False)
        cases = F.when(prev == s, cond) if cases is None else cases.when(prev == s, cond)
    return cases.otherwise(F.lit(False))


def transition_audit(events: DataFrame, bucket: str = "hour") -> DataFrame:
    """Every status event with its predecessor and a violation reason.

    First event must be 'proposed'; terminal actions accept no later event;
    otherwise the next status must be an allowed transition (or a re-opening
    revision back to 'proposed' from approved / in progress).
    """
    s = sequenced(events, bucket=bucket)
    prev, nxt = F.col("previous_status"), F.col("status")
    reason = (
        F.when(nxt.isNull() | ~nxt.isin(list(STATUSES)), "Unknown status")
        .when(prev.isNull() & (nxt != "proposed"), "Action must start as proposed")
        .when(prev.isNull(), None)
        .when(prev.isin(list(TERMINAL)), "Terminal action changed")
        .when(~_allowed(prev, nxt), "Invalid status transition")
    )
    return s.select(
        "action_id", "sequence", "event_id", "created_at", "previous_status", "status",
        reason.alias("violation"), reason.isNull().alias("valid"),
    )


def current_state(events: DataFrame) -> DataFrame:
    """Per action: latest status, event count, first/last event time, open flag,
    number of proposals (E02, W10).  Pure aggregates: a hot action is split by
    partial aggregation."""
    order = F.struct("created_at", "event_id")
    return events.groupBy("action_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.min("created_at").alias("first_event_at"),
        F.max("created_at").alias("last_event_at"),
        F.max_by("status", order).alias("current_status"),
        F.count_if(F.col("status") == "proposed").alias("proposals"),
    ).withColumn("is_open", ~F.col("current_status").isin(list(TERMINAL)))


def violation_summary(audit: DataFrame) -> DataFrame:
    """Per action: events, violations, first violating sequence (E03 roll-up)."""
    return audit.groupBy("action_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(~F.col("valid")).alias("violations"),
        F.min(F.when(~F.col("valid"), F.col("sequence"))).alias("first_violation_sequence"),
    )


def _field(c: F.Column) -> F.Column:
    """Unambiguous text of one field: hexadecimal, with null apart from empty."""
    return F.coalesce(F.concat(F.lit("="), F.hex(c)), F.lit("-"))


def event_digest() -> F.Column:
    """SHA-256 over every field of an event; no two different events share the hashed text."""
    return F.sha2(
        F.concat_ws(
            ",",
            _field(F.col("event_id").cast("string")),
            _field(F.date_format("created_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")),
            _field(F.col("status")),
            _field(F.col("note")),
            _field(F.col("value").cast("decimal(38,12)").cast("string")),
        ),
        256,
    )


def fingerprints(events: DataFrame) -> DataFrame:
    """Order-independent snapshot fingerprint per action.

    The 64 hexadecimal digits of each event's digest are cut into four numbers which are
    summed exactly, so partial sums merge in any order, repeated events count, and any
    changed, added or removed event changes the four sums.
    """
    e = events.select("action_id", event_digest().alias("_d"))
    parts = {f"_s{i}": F.conv(F.substring("_d", 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)") for i in range(4)}
    sums = e.withColumns(parts).groupBy("action_id").agg(
        F.count(F.lit(1)).alias("events"), *[F.sum(p).cast("string").alias(p) for p in parts]
    )
    return sums.select("action_id", "events", F.concat_ws("-", *parts).alias("fingerprint"))


def verify_fingerprints(stored: DataFrame, events: DataFrame) -> DataFrame:
    """Compare stored fingerprints with those of the events as they are now."""
    kept = stored.select("action_id", F.col("fingerprint").alias("stored_fingerprint"))
    now = fingerprints(events).select("action_id", F.col("fingerprint").alias("current_fingerprint"))
    state = (
        F.when(F.col("stored_fingerprint").isNull(), "added")
        .when(F.col("current_fingerprint").isNull(), "missing")
        .when(F.col("stored_fingerprint") == F.col("current_fingerprint"), "intact")
        .otherwise("altered")
    )
    return kept.join(now, "action_id", "full_outer").select("action_id", state.alias("state"))


# ---------------------------------------------------------------- E01
def _store(spark: SparkSession, path: str):
    """(file system, Hadoop path maker) of the log's store."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def log_version(spark: SparkSession, path: str) -> tuple[int, list[str]]:
    """Latest version of an event log and the data folders it admits, in order of commit."""
    fs, make = _store(spark, path)
    root = make(f"{path}/manifest")
    if not fs.exists(root):
        return 0, []
    versions = sorted(str(f.getPath().getName()) for f in fs.listStatus(root) if str(f.getPath().getName()).isdigit())
    folders = []
    for v in versions:
        names = [str(f.getPath().getName()) for f in fs.listStatus(make(f"{path}/manifest/{v}")) if f.isFile()]
        folders += [f"{path}/data/append={n}" for n in names if not n.startswith((".", "_"))]
    return (int(versions[-1]) if versions else 0), folders


def read_events(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The committed events; files of writers that have not committed are not read."""
    _, folders = log_version(spark, path)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders).select(*schema.names)


def _commit(spark: SparkSession, path: str, version: int, folder: str) -> bool:
    """Admit a data folder as ``version``; false when another writer has that version.

    A folder with one file named after the data is renamed into place. Where the version is
    taken, a rename either fails or puts the folder inside the winner's, so the file is missing
    from the place that counts."""
    fs, make = _store(spark, path)
    own, place = f"{path}/manifest/.{folder}", f"{path}/manifest/{version:020d}"
    fs.create(make(f"{own}/{folder}"), False).close()
    won = bool(fs.rename(make(own), make(place))) and bool(fs.exists(make(f"{place}/{folder}")))
    if not won:
        fs.delete(make(own), True)
        fs.delete(make(f"{place}/.{folder}"), True)
    return won


def append_events(events: DataFrame, path: str, key: str = "event_id") -> int:
    """Append the events whose ``key`` the log does not hold yet (E01); returns how many.

    Every append is a data folder of its own, partitioned by event date, and a version of the
    manifest that admits it. Keys are checked against one version and admitted as the next: when
    another writer takes that version first, the rows are checked again and written anew. So each
    event is added once, by retries and by writers at the same time, and no file is rewritten."""
    spark = events.sparkSession
    fs, make = _store(spark, path)
    new = events.dropDuplicates([key]).withColumn("event_date", F.to_date("created_at"))
    while True:
        version, _ = log_version(spark, path)
        rows = new.join(read_events(spark, path, new.schema).select(key), key, "left_anti")
        folder = uuid.uuid4().hex
        counted = Observation()
        rows.observe(counted, F.count(F.lit(1)).alias("n")).write.partitionBy("event_date").parquet(f"{path}/data/append={folder}")
        added = spark.read.parquet(f"{path}/data/append={folder}").count() if counted.get["n"] else 0
        if added and _commit(spark, path, version + 1, folder):
            return added
        fs.delete(make(f"{path}/data/append={folder}"), True)
        if not added:
            return 0
