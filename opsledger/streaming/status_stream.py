"""Incremental hourly status counts of the action log with Structured Streaming.

The marts are rebuilt in batch; this is the incremental form of
the action-log roll-up (E02) over the append-only ``events`` folder: new files
are picked up as they land, late events are accepted up to the watermark, and
each closed hour is emitted once (append mode).  State is bounded by the
watermark (open hours only), and the checkpoint lives under the cluster's
``spark.checkpoint.dir`` so a restarted query resumes exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampType

from ..session import checkpoint_dir
from ..sources.adapters import Source

EVENT_SCHEMA = StructType(
    [
        StructField("event_id", LongType()),
        StructField("ts", TimestampType()),
        StructField("user_id", LongType()),
        StructField("event_type", StringType()),
        StructField("value", DoubleType()),
        StructField("props", StringType()),
    ]
)


def hourly_status_counts(events: DataFrame, watermark: str = "2 hours") -> DataFrame:
    """(window_start, window_end, status, events, actions_value) per hour; works on
    a batch or a streaming DataFrame of raw events."""
    status = F.element_at(
        F.create_map(*[F.lit(x) for kv in Source.ACTION_STATUS.items() for x in kv]), F.col("event_type")
    )
    e = events.withColumn("status", status)
    if e.isStreaming:
        e = e.withWatermark("ts", watermark)
    return (
        e.groupBy(F.window("ts", "1 hour"), "status")
        .agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("total_value"))
        .select(
            F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
            "status", "events", "total_value",
        )
    )


def start(
    spark: SparkSession,
    source_folder: str,
    sink_path: str,
    checkpoint: str | None = None,
    file_name_glob: str = "events*.parquet",
    available_now: bool = False,
) -> StreamingQuery:
    """Start the stream: ``source_folder`` files matching ``file_name_glob`` ->
    hourly counts appended as Parquet to ``sink_path``."""
    raw = (
        spark.readStream.schema(EVENT_SCHEMA)
        .option("pathGlobFilter", file_name_glob)
        .option("maxFilesPerTrigger", 64)
        .parquet(source_folder)
    )
    ckpt = checkpoint or checkpoint_dir(spark).rstrip("/") + "/opsledger-streams/hourly_status"
    writer = (
        hourly_status_counts(raw)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", sink_path)
        .option("checkpointLocation", ckpt)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
