"""Spark session settings the library relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Session settings every operator assumes (safe to call repeatedly)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    return spark


def size_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Cut shuffles of large inputs finely enough that a task sorts its part in memory.

    The part files' rows take some four times their bytes in a shuffle, and a task should get about
    64 MB of them; small parts are merged again by adaptive execution. Up to 200 the map side
    holds no rows (one file per part), so there it ends."""
    wanted = min(200, 4 * input_bytes // (64 << 20))
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a local session without the setting gets a scratch folder. On a cluster a missing
    setting is an error: executors would write to folders that nobody else sees.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="opsledger-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def local_session(cores: int | str = "*", app: str = "opsledger") -> SparkSession:
    """Local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", os.environ.get("OPSLEDGER_SHUFFLE", "8"))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once as Parquet in the checkpoint folder and read it back.

    For steps of an iterative job: the lineage ends at files that all executors see."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/opsledger-steps/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def dropped(table: DataFrame) -> None:
    """Delete a table that :func:`stored` wrote, once its successor is stored."""
    path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table._stored_at)
    path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
