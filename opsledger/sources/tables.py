"""Named table scans (S01/S02/S03/S06) and the driver parquet folder."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def read_parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """``<folder>/<name>.parquet`` (a file or a folder of part files)."""
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def read_csv(
    spark: SparkSession, folder: str, name: str, schema: StructType
) -> DataFrame:
    """Named CSV scan with a declared schema; ``.csv.gz`` is read the same way.

    Empty fields stay null (never 0); nothing is inferred.
    """
    path = f"{folder.rstrip('/')}/{name}.csv"
    # asked of the store that holds the folder: it need not be a local disk
    plain = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not plain.getFileSystem(spark._jsc.hadoopConfiguration()).exists(plain):
        path += ".gz"
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )


def write_csv(df: DataFrame, path: str, gzip: bool = False, scale: int = 8) -> None:
    """CSV sink: header, no index, money with a fixed number of decimals."""
    out = df.select(
        *[
            df[f.name].cast(f"decimal(28,{scale})").alias(f.name)
            if f.dataType.typeName() == "double"
            else df[f.name]
            for f in df.schema.fields
        ]
    )
    writer = out.write.mode("overwrite").option("header", True)
    if gzip:
        writer = writer.option("compression", "gzip")
    writer.csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON records sink (one object per line)."""
    df.write.mode("overwrite").json(path)
