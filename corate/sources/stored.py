"""Tables stored by a key: bucketed and sorted, so that repeated joins and
aggregates on it need no exchange.

A table goes to the shared folder and is listed in the session's catalog,
which keeps its bucketing; a plan that reads it takes its rows as dealt by
the key. Ratings stored by user give statistics and profiles without a
shuffle of the ratings; profiles stored by item give the pair join without
one (``pairs.co_rating_pairs(..., dealt=True)``). Items with more raters
than a block are still split, by a shuffle of their rows alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from corate.config import scratch_path
from corate.operators.blocks import shuffle_partitions


def by_key(df: DataFrame, name: str, key: str, buckets: int | None = None) -> DataFrame:
    """``df`` stored in ``buckets`` buckets by ``key`` (as many as the session
    has shuffle partitions unless stated), sorted by it. The rows are dealt
    by key before they are written, so that a bucket is one file."""
    spark = df.sparkSession
    n = buckets or shuffle_partitions(spark)
    table = f"corate_{name}_{uuid.uuid4().hex}"
    (df.repartition(n, key).write.bucketBy(n, key).sortBy(key)
     .option("path", scratch_path(spark, table)).saveAsTable(table))
    return spark.table(table)
