"""A dense order index of a table's keys without a window over one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored


def dense_index(df: DataFrame, key: str, name: str) -> tuple[DataFrame, int]:
    """``df`` with ``name`` = place of its row in the order of ``key`` (from 0), and the number of rows.

    Rows are range-partitioned by the key and numbered inside each partition; the partitions' row
    counts (one per partition on the driver) give the offsets. ``key`` must be unique and not null.
    """
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = stored(df.repartitionByRange(tasks, key).withColumn("_part", F.spark_partition_id()), "indexed")
    counts = parts.groupBy("_part").count().orderBy("_part").collect()
    offsets, total = [], 0
    for r in counts:
        offsets.append((r["_part"], total))
        total += r["count"]
    if not offsets:
        return parts.drop("_part").withColumn(name, F.lit(None).cast("long")), 0
    starts = F.broadcast(spark.createDataFrame(offsets, "_part int, _start long"))  # a row per partition
    nth = F.row_number().over(Window.partitionBy("_part").orderBy(key)) - 1
    return parts.join(starts, "_part").withColumn(name, F.col("_start") + nth).drop("_part", "_start"), total
