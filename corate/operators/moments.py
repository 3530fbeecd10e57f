"""Mean and deviation of the overlaps of all user pairs without their pairs.

An item of ``d`` raters is in ``d (d - 1) / 2`` pairs, so the sum of overlaps
follows from the items' degrees alone. The sum of squares needs the pairs of
one side only: over all ordered pairs of users, the squared overlaps add up
to the squared rater counts shared by all ordered pairs of items. Items are
therefore split at ``heavy`` raters. What light items alone add to an overlap
is counted per pair of users (at most ``heavy`` raters meet on an item); what
involves a heavy item is counted per pair of items, along the users' own
lists. An item that a third of all users rate makes a row per rating of these
users, instead of a row per pair of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corate.config import materialize
from corate.operators.blocks import DEFAULT_BLOCK_SIZE, join_split
from corate.operators.pairs import co_rated_counts

# Raters above which an item's pairs are counted by items instead of users.
HEAVY_RATERS = 256


def _whole(x: Column) -> Column:
    return x.cast("decimal(38,0)")


def overlap_moments(ratings: DataFrame, heavy: int = HEAVY_RATERS,
                    block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """One row ``n_users, all_pairs, average, stddev`` (population) over all
    ``U (U + 1) / 2`` user pairs, self-pairs included.

    Sums are whole numbers, divided last. Without ratings both are NULL.
    ``(user_id, item_id)`` must be unique.
    """
    raters = ratings.groupBy("item_id").agg(F.count(F.lit(1)).alias("_d"))
    marked = materialize(ratings.select("user_id", "item_id").join(
        raters.select("item_id", (F.col("_d") > heavy).alias("_heavy")), "item_id"), "marked")

    # every branch adds to the sum of overlaps (first) and to twice the sum
    # of their squares (twice)
    none = F.lit(0).cast("long")
    n, light = F.col("_n").cast("decimal(19,0)"), F.col("_l").cast("decimal(19,0)")
    per_user = marked.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(~F.col("_heavy")).alias("_l")).select(
        F.lit(1).cast("long").alias("users"), _whole(none).alias("first"), _whole(n * n + light * light).alias("twice"))
    d = F.col("_d").cast("decimal(19,0)")
    per_item = raters.select(none.alias("users"), _whole(F.expr("_d * (_d + 1) div 2")).alias("first"),
                             _whole(F.when(F.col("_d") > heavy, d * d).otherwise(0)).alias("twice"))
    moments = per_user.unionByName(per_item)
    for shared in (_light_overlaps(marked, block_size), _heavy_overlaps(marked, block_size)):
        x = F.col("common").cast("decimal(18,0)")
        moments = moments.unionByName(shared.select(
            none.alias("users"), _whole(none).alias("first"), _whole(x * x * 2).alias("twice")))

    total = moments.agg(F.coalesce(F.sum("users"), none).alias("n_users"),
                        _whole(F.sum("first")).alias("first"), _whole(F.sum("twice")).alias("twice"))
    pairs = F.expr("n_users * (n_users + 1) div 2")
    divisor = F.nullif(pairs, F.lit(0)).cast("double")
    first = F.col("first")
    spread = _whole(F.col("twice") * _whole(pairs)) - _whole(first * first * 2)
    return total.select("n_users", pairs.alias("all_pairs"),
                        (first.cast("double") / divisor).alias("average"),
                        F.sqrt(spread.cast("double") / 2 / divisor / divisor).alias("stddev"))


def _light_overlaps(marked: DataFrame, block_size: int) -> DataFrame:
    """``common`` of each user pair ``u < v`` in items that aren't heavy."""
    return co_rated_counts(marked.where(~F.col("_heavy")), block_size).select("common")


def _heavy_overlaps(marked: DataFrame, block_size: int) -> DataFrame:
    """``common`` raters of each item pair with a heavy item in it."""
    left = marked.where("_heavy").select("user_id", F.col("item_id").alias("i"))
    right = marked.select("user_id", F.col("item_id").alias("j"), F.col("_heavy").alias("_both"))
    met = join_split(left, right, "user_id", ["i"], ["j"], block_size).where(~F.col("_both") | (F.col("i") < F.col("j")))
    return met.groupBy("i", "j").agg(F.count(F.lit(1)).alias("common")).select("common")
