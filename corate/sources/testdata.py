"""Rating view over the TPC-H-style test tables.

No test table holds ratings, so ``lineitem ⋈ orders`` stands in: the
customer is the user, the part is the item, and the rating is the largest
``ceil(l_quantity / 10)`` the customer ordered of that part (a whole number
in 1..5). Taking the maximum makes ``(user_id, item_id)`` unique.

The split into train and test is a fixed hash of the key, so it needs no
sampling and gives the same rows in any engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The split expression. A row is a test row when
# (user_id * 7919 + item_id * 104729) % 10007 % 5 = 0 (about 20 %).
SPLIT_USER_FACTOR = 7919
SPLIT_ITEM_FACTOR = 104729
SPLIT_MODULUS = 10007
SPLIT_FOLDS = 5

# The personal user's ratings. The user rates every catalogue
# item whose id satisfies (item_id * 7919) % 10007 % 8 = 0 (about one item
# in eight), with rating 1 + (item_id * 31 + length(title)) % 5.
PERSONAL_FOLDS = 8


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(user_id, item_id, rating)`` before de-duplication (one row per line)."""
    lineitem = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    # Keys are stated non-null here, once, so that the filters Spark infers
    # from later joins are already implied and every consumer of the view
    # plans the same subtree (which exchange reuse then computes once).
    return (lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .where(F.col("o_custkey").isNotNull() & F.col("l_partkey").isNotNull())
            .select(F.col("o_custkey").alias("user_id"),
                    F.col("l_partkey").alias("item_id"),
                    F.ceil(F.col("l_quantity") / F.lit(10.0)).cast("double").alias("rating")))


def fold(user_id: str = "user_id", item_id: str = "item_id"):
    """The split fold of a key: 0 for test rows, 1..4 for train rows."""
    return ((F.col(user_id) * SPLIT_USER_FACTOR + F.col(item_id) * SPLIT_ITEM_FACTOR)
            % SPLIT_MODULUS % SPLIT_FOLDS)


def ratings(spark: SparkSession, sf_dir: str, with_fold: bool = False) -> DataFrame:
    """``(user_id BIGINT, item_id BIGINT, rating DOUBLE)``, unique per key.

    ``with_fold=True`` adds the split fold as an output of the same
    aggregate. A filter on it cannot be pushed below the aggregate, so the
    train and test halves share one computation of the view instead of
    each re-running the join with its own pushed-down filter.
    """
    aggs = [F.max("rating").alias("rating")]
    if with_fold:
        aggs.append(F.min(fold()).alias("fold"))
    return raw_ratings(spark, sf_dir).groupBy("user_id", "item_id").agg(*aggs)


def split(rated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` by the fixed hash of ``(user_id, item_id)``."""
    if "fold" in rated.columns:
        test = F.col("fold") == 0
        rated_cols = [c for c in rated.columns if c != "fold"]
        return rated.where(~test).select(*rated_cols), rated.where(test).select(*rated_cols)
    test = fold() == 0
    return rated.where(~test), rated.where(test)


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(item_id, title)`` from ``part``."""
    return _table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"))


def personal_catalogue(catalogue: DataFrame) -> DataFrame:
    """``(item_id, title, rating)``: the catalogue with the personal ratings.

    ``rating`` is NULL for items the personal user did not rate, like an
    empty third field in a ``personal.csv`` line.
    """
    rated = (F.col("item_id") * SPLIT_USER_FACTOR) % SPLIT_MODULUS % PERSONAL_FOLDS == 0
    value = (F.lit(1) + (F.col("item_id") * 31 + F.length("title")) % 5).cast("double")
    return catalogue.select("item_id", "title", F.when(rated, value).alias("rating"))
