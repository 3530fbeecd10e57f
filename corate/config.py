"""Session settings and lineage helpers.

The library never creates a session; callers pass one in. ``SPARK_CONF``
lists the settings the plans are written for, so a job submitter (or
``bench.py`` and the tests) can apply them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are designed around. AQE re-plans joins from
# measured sizes (a broadcast only when the shuffled side is proven small),
# splits skewed partitions of hot users or items, and coalesces small
# partitions. forceOptimizeSkewedJoin lets a skewed join be split even when
# the split costs a small exchange afterwards; our joins are followed by
# partial aggregates, so that exchange is tiny compared with a straggler.
SPARK_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    # A sort-merge join becomes a shuffled hash join (no sorts) only when
    # every partition of the build side is measured below this size, which
    # bounds the in-memory hash table per task.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "128m",
    "spark.sql.session.timeZone": "UTC",
    # Delete checkpoint files once the DataFrames using them are gone, so a
    # long session does not accumulate them in the shared folder.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def apply_conf(builder: SparkSession.Builder, shuffle_partitions: int | None = None
               ) -> SparkSession.Builder:
    for key, value in SPARK_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for scratch tables.

    Taken from the session (``spark.checkpoint.dir``, or the checkpoint
    folder set on the context); it is the cluster's to name, whatever its
    scheme. A session that names none gets a folder in its warehouse, unless
    that is a folder of one machine (scheme ``file``) and the session runs on
    several: its executors would each write to a disk of their own, so this
    raises instead.
    """
    current = spark.sparkContext.getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None) or current
    if named:
        return named
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    scheme = qualified_scheme(spark, warehouse)
    if not shared_folder(scheme, spark.sparkContext.master):
        raise ValueError(f"the warehouse {warehouse} is a folder of one machine; "
                         "set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse}/_scratch"


def qualified_scheme(spark: SparkSession, path: str) -> str:
    """The scheme of a path, the default file system's where it names none."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri().getScheme()


def shared_folder(scheme: str, master: str) -> bool:
    """Whether all executors of a session see a folder of this scheme."""
    one_machine = master == "local" or master.startswith("local[")
    return scheme != "file" or one_machine


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder, deleted when the
    application ends."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/corate-{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(folder)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    # a path that doesn't exist yet would not be noted
    files.mkdirs(where)
    files.deleteOnExit(where)
    return f"{folder}/data"


# Shuffle files are deleted once the query that wrote them has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Used for intermediates that several branches or actions read (similarity
    pairs, neighbour lists). The table cuts the lineage, survives the loss
    of the executors that computed it, is compressed, and lets each reader
    take only the columns it needs. What was shuffled to make it is deleted
    when it is written, not when the driver happens to collect garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with _shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def first_row(df: DataFrame):
    """``df.first()``; what was shuffled for it is deleted."""
    with _shuffles_removed(df.sparkSession):
        return df.first()


def in_rounds(rounds: int, part: Callable[[int], DataFrame], name: str) -> DataFrame:
    """The rows of ``part(0)`` to ``part(rounds - 1)``.

    A single part is returned as it is. Of several, each is written as
    ``materialize`` does before the next begins, so that only one round's
    shuffles lie on disk at a time."""
    out = part(0)
    if rounds == 1:
        return out
    spark, schema = out.sparkSession, out.schema
    path = scratch_path(spark, name)
    for at in range(rounds):
        with _shuffles_removed(spark):
            (out if at == 0 else part(at)).write.parquet(f"{path}/{at}", compression="zstd")
    return spark.read.schema(schema).parquet(*[f"{path}/{at}" for at in range(rounds)])
