"""Equi-joins whose hot keys are split over many tasks.

A key with ``l`` rows on one side and ``r`` on the other is ``l * r`` joined
rows in one task, however small both inputs are in bytes, so Spark's skew
handling (which looks at bytes) leaves it alone. ``split_hot`` cuts the rows
of such keys into blocks on both sides; each block pair is a join key of
its own. Whatever is summed over the joined rows is unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of one key and side in a block.
DEFAULT_BLOCK_SIZE = 4096
# Joined rows that a task forms, sorts or groups (some 100 bytes each in
# memory); more rows get more tasks.
ROWS_PER_TASK = 1 << 21
# Joined rows whose inputs lie on disk at a time (16 to 40 bytes each); more
# rows are formed in rounds.
ROWS_PER_ROUND = 1 << 28


def bucket(members: Sequence[str], n: Column) -> Column:
    """A row's block among ``n``, by the hash of its member columns."""
    return F.pmod(F.xxhash64(*members), n.cast("long")).cast("int")


def spread(df: DataFrame, keys: Sequence[str], tasks: int | None = None) -> DataFrame:
    """``df`` dealt by ``keys`` to a stated number of partitions (the
    session's, if not given).

    It is the exchange that a join on the keys needs anyway. Stating the
    number keeps AQE from merging the blocks again because they are small
    in bytes.
    """
    return df.repartition(tasks or shuffle_partitions(df.sparkSession), *keys)


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Partitions for so many rows: the session's number, or as many more as
    keep each of them within ``ROWS_PER_TASK`` rows."""
    return max(shuffle_partitions(spark), -(-rows // ROWS_PER_TASK))


def rounds_for(rows: int) -> int:
    """Rounds for so many rows: as many as keep each of them within
    ``ROWS_PER_ROUND`` rows."""
    return max(1, -(-rows // ROWS_PER_ROUND))


def in_round(member: Column, at: int, rounds: int) -> Column | None:
    """Whether a member is dealt to round ``at``; None where there is one."""
    return None if rounds == 1 else F.pmod(F.xxhash64(member, F.lit("round")), F.lit(rounds).cast("long")) == at


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions (Spark's own default where
    it is unset, the session's parallelism where it is no number)."""
    # no default is passed: Spark would check it against the setting's type
    setting = spark.conf.get("spark.sql.shuffle.partitions")
    return int(setting) if setting.isdigit() else spark.sparkContext.defaultParallelism


def join_split(left: DataFrame, right: DataFrame, key: str, left_members: Sequence[str],
               right_members: Sequence[str], block_size: int = DEFAULT_BLOCK_SIZE,
               tasks: int | None = None) -> DataFrame:
    """``left.join(right, key)`` with hot keys split into blocks.

    The member columns tell the rows of one key apart. Column names other
    than ``key`` must differ between the sides. Both counts are partial
    aggregates; the list of hot keys is joined without a hint, so AQE
    broadcasts it only when it is measured small.
    """
    n_left = left.groupBy(key).agg(F.count(F.lit(1)).alias("_nl"))
    n_right = right.groupBy(key).agg(F.count(F.lit(1)).alias("_nr"))
    size = F.lit(block_size)
    hot = (n_left.join(n_right, key)
           .where(F.col("_nl") * F.col("_nr") > size * size)
           .select(key, F.ceil(F.col("_nl") / size).cast("int").alias("_bl"),
                   F.ceil(F.col("_nr") / size).cast("int").alias("_br")))

    def blocked(side: DataFrame, members: Sequence[str], own: str, other: str) -> DataFrame:
        joined = side.join(hot, key, "left")
        mine = F.when(F.col(own).isNull(), 0).otherwise(bucket(members, F.col(own)))
        theirs = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1))
        return joined.select(*side.columns, mine.alias(f"_i{own}"), theirs.alias(f"_i{other}"))

    keys = [key, "_i_bl", "_i_br"]
    return (spread(blocked(left, left_members, "_bl", "_br"), keys, tasks)
            .join(spread(blocked(right, right_members, "_br", "_bl"), keys, tasks), keys).drop("_i_bl", "_i_br"))
