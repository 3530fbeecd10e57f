"""Dense positions of a sorted key, computed without a single-partition sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corate.config import materialize
from corate.operators.blocks import shuffle_partitions


def dense_index(df: DataFrame, key: str, idx: str = "idx",
                num_partitions: int | None = None) -> DataFrame:
    """``(key, idx)`` where ``idx`` is 0, 1, 2, ... in ascending ``key`` order.

    Keys must be unique. The keys are range-partitioned, each partition
    numbers its own rows, and a table with one row per partition (so at
    most ``num_partitions`` rows, which makes the broadcast safe) supplies
    each partition's starting offset. ``row_number()`` over the whole table
    would move every key into one task instead.

    Range bounds come from a sample, so a second evaluation may cut the
    partitions elsewhere. The numbered rows are therefore written once,
    before they are counted.
    """
    n = num_partitions or shuffle_partitions(df.sparkSession)
    ranged = (df.select(key).repartitionByRange(n, key)
              .withColumn("_part", F.spark_partition_id()))
    local = materialize(ranged.withColumn(
        "_pos", F.row_number().over(Window.partitionBy("_part").orderBy(key))), "index")
    sizes = local.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return local.join(F.broadcast(offsets), "_part").select(
        key, (F.col("_off") + F.col("_pos") - 1).cast("long").alias(idx))
