"""Files of any size as blocks of bytes, by Spark's own readers: the store need not be a local disk."""

from __future__ import annotations

import re

from pyspark import RDD
from pyspark.serializers import NoOpSerializer
from pyspark.sql import SparkSession

#: Bytes of a block.
BLOCK = 16 << 10


def pattern(path: str) -> str:
    """The path pattern that only ``path`` matches; readers cut a list of patterns at commas outside braces."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path).replace(",", r"{\,}")


def file_blocks(spark: SparkSession, path: str, length: int) -> tuple[RDD, bytes] | None:
    """(blocks, rest) of a file of ``length`` bytes, a block at least: its blocks in order, as one partition, and
    what follows them.

    One task reads the file from start to end and holds a few blocks at a time. Its reader fails on a
    last record that is shorter than a block; the limit ends the task before it. These bytes (fewer
    than ``BLOCK``) are read by the driver. None if a compression belongs to the name: the reader
    takes no such file.
    """
    sc, jvm, n = spark.sparkContext, spark._jvm, length // BLOCK
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    if jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(hpath) is not None:
        return None
    conf.setLong("mapreduce.input.fileinputformat.split.minsize", length)
    records = sc._jsc.sc().binaryRecords(pattern(path), BLOCK, conf)
    whole = spark._jsparkSession.createDataset(records, jvm.org.apache.spark.sql.Encoders.BINARY()).coalesce(1).limit(n)
    stream = hpath.getFileSystem(conf).open(hpath)
    try:
        stream.seek(n * BLOCK)
        rest = bytes(stream.readNBytes(length - n * BLOCK))
    finally:
        stream.close()
    return RDD(whole.javaRDD(), sc, NoOpSerializer()), rest
