"""Helpers the operators share: shared storage, checked columns, word patterns."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that ends a word: blank and the control characters \x09 to \x0D.
GAP = "\\x20\\x09-\\x0D"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir`` of the session.

    Only a local session (tests, bench) without the setting gets a folder of its own;
    on a cluster a missing setting is an error, as a machine-local folder would lose rows.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="opsledger-llm-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage, keeps row identity fixed for later passes and survives lost executors.
    """
    path = f"{shared_folder(df.sparkSession)}/llm-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def dropped(table: DataFrame) -> None:
    """Delete a table that ``stored`` wrote, once what was made of it is stored itself."""
    path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table._stored_at)
    path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


#: Bytes of rows that a Python task gets at once; they lie there several times over.
BATCH_BYTES = 4 << 20


def in_small_batches(job: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Let the Python tasks that ``job`` runs before it returns get their rows in batches of few MB.

    A longer row is a batch of its own. The session's setting holds again afterwards.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"

    @functools.wraps(job)
    def run(df: DataFrame, *args, **more) -> DataFrame:
        conf = df.sparkSession.conf
        before = conf.get(key)
        conf.set(key, str(BATCH_BYTES))
        try:
            return job(df, *args, **more)
        finally:
            conf.set(key, before)

    return run


def private(df: DataFrame) -> str:
    """A prefix for helper columns that no column of ``df`` begins with."""
    prefix = "__"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


class Shared:
    """A broadcast value of this package's own classes: they travel with it as bytes."""

    def __init__(self, spark: SparkSession, value) -> None:
        self._raw = spark.sparkContext.broadcast(cloudpickle.dumps(value))
        self._held: list = []

    def __getstate__(self) -> dict:
        return {"_raw": self._raw, "_held": []}

    @property
    def value(self):
        if not self._held:
            self._held.append(cloudpickle.loads(self._raw.value))
        return self._held[0]


def word_count(text: Column) -> Column:
    """Number of words of a text (null: 0), without an array of the words.

    Every word with the white space around it becomes one letter; the rest is a length.
    """
    packed = F.regexp_replace(text, f"[{GAP}]*+[^{GAP}]++[{GAP}]*+", "x")
    n = F.when(text.rlike(f"[^{GAP}]"), F.length(packed).cast("long")).otherwise(F.lit(0).cast("long"))
    return F.coalesce(n, F.lit(0).cast("long"))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only, whatever the locale."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
