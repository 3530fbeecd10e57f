"""The k nearest neighbours without aggregating every pair.

Most pairs of users rate one item in common, and their similarity is that
one product; only few of them are near enough to enter a list of k. The pair
join finds out which pairs these are while it forms them:

* every user of up to ``max_items`` ratings carries the list of their items.
  If the lists of two raters of an item share that item alone, the joined row
  is the whole pair and its product the similarity;
* every user carries a lower bound of the similarity of their k-th best
  neighbour. It comes from index lists cut short: of each item only the
  ``heads`` raters of the largest and of the least weight are paired with
  its other raters, and of these the k-th best proven pair is the bound;
* a row that is a whole pair below both users' bounds is dropped in the join,
  before any aggregate or shuffle. All other rows are kept, so every pair
  that is left has its full sums, and the lists are exact.

An item's largest weight thus bounds what its list can add, and a list is
only followed to where it can still matter, per pair of users. What cannot be
proven (users of more than ``max_items`` items carry no list) is summed as
always.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corate.config import materialize
from corate.operators import pairs as P
from corate.operators.blocks import DEFAULT_BLOCK_SIZE, join_split, spread, tasks_for
from corate.operators.neighbors import rank_neighbors, ranked
from corate.operators.pairs import Load, co_rating_pairs, cosine, pair_load, symmetric

# Ratings up to which a user carries the list of their items, and raters at
# either end of an item's list that give the bounds. Both change what is
# dropped, never the lists of neighbours.
MAX_ITEMS = 256
DEFAULT_HEADS = 8
# Similarities are ranked after rounding to 12 places, so bounds leave room.
MARGIN = 1e-11


def _single(a: Column, b: Column) -> Column:
    """Whether two raters of an item are known to share no second item."""
    return F.coalesce(F.size(F.array_intersect(a, b)) == 1, F.lit(False))


def listed(profiles: DataFrame, max_items: int = MAX_ITEMS) -> DataFrame:
    """``(user_id, item_id, n_items, w)`` of users with a norm, and ``_items``:
    the user's items by hash, NULL for users of more than ``max_items`` or with
    two items of one hash."""
    rows = profiles.where(F.col("w").isNotNull()).select("user_id", "item_id", "n_items", "w")
    lists = (rows.where(F.col("n_items") <= max_items).groupBy("user_id")
             .agg(F.collect_list(F.hash("item_id")).alias("_items"))
             .where(F.size(F.array_distinct("_items")) == F.size("_items")))
    return rows.join(lists, "user_id", "left")


def list_heads(rows: DataFrame, heads: int) -> DataFrame:
    """The raters at either end of each item's list, by weight.

    One window ranks both ends, each by distance from zero. A union of two
    ranked halves would keep their partitioning by item, and a join that
    splits the partitions of one half alone cannot put the halves together."""
    weighted = rows.where(F.col("w") != 0).withColumn("_end", F.col("w") > 0)
    rank = F.row_number().over(
        Window.partitionBy("item_id", "_end").orderBy(F.abs(F.col("w")).desc(), "user_id"))
    return weighted.withColumn("_r", rank).where(F.col("_r") <= heads).drop("_r", "_end")


def bounds(rows: DataFrame, k: int, heads: int = DEFAULT_HEADS,
           block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """``(user_id, _least)``: the k-th best similarity of the pairs that the
    ends of the item lists prove; users with fewer have no row."""
    ends = list_heads(rows, heads).select(
        "item_id", F.col("user_id").alias("_nb"), F.col("w").alias("_w"), F.col("_items").alias("_theirs"))
    joined = join_split(rows, ends, "item_id", ["user_id"], ["_nb"], block_size)
    best = joined.where((F.col("user_id") != F.col("_nb")) & (F.col("w") * F.col("_w") > 0)
                        & _single(F.col("_items"), F.col("_theirs"))
                        ).select("user_id", "_nb", (F.col("w") * F.col("_w")).alias("sim"))
    rank = F.row_number().over(Window.partitionBy("user_id").orderBy(F.col("sim").desc(), "_nb"))
    return (best.withColumn("_r", rank).where(F.col("_r") <= k).where(F.col("_r") == k)
            .select("user_id", F.col("sim").alias("_least")))


def near_pairs(profiles: DataFrame, k: int, max_items: int = MAX_ITEMS, heads: int = DEFAULT_HEADS,
               block_size: int = DEFAULT_BLOCK_SIZE, load: Load | None = None) -> DataFrame:
    """The part of ``pairs.co_rating_pairs`` that can hold one of the k
    nearest neighbours of either user."""
    rows = listed(profiles, max_items)
    # written once: the pair join reads these rows for ordinary and hot items
    known = materialize(rows.join(bounds(rows, k, heads, block_size), "user_id", "left").withColumn(
        "_least", F.coalesce(F.col("_least"), F.lit(float("-inf"))) - F.lit(MARGIN)), "known")
    return co_rating_pairs(
        known, block_size, ["_items", "_least"],
        lambda a, b: (a("w") * b("w") >= F.least(a("_least"), b("_least")))
        | ~_single(a("_items"), b("_items")), load=load or pair_load(known))


def list_bounds(rows: DataFrame, k: int, heads: int, block_size: int, tasks: int) -> DataFrame:
    """``bounds`` with the raters of an item read as lists (the ends of a hot
    item's lists are those of each of its buckets)."""
    def end(sign: int) -> Column:
        weighted = F.filter("right", lambda x: x["w"] * sign > 0)
        by_weight = F.transform(weighted, lambda x: F.struct(
            (x["w"] * -sign).alias("o"), x["user_id"].alias("user_id"), x["_items"].alias("_items")))
        return F.slice(F.array_sort(by_weight), 1, heads)
    a = F.col("a.w")
    near = F.when(a > 0, F.col("high")).when(a < 0, F.col("low"))
    proven = F.filter(near, lambda x: (x["user_id"] != F.col("a.user_id")) & _single(F.col("a._items"), x["_items"]))
    products = (P.met(rows, ["user_id", "w", "_items"], block_size, tasks)
                .select("left", end(1).alias("high"), end(-1).alias("low"))
                .select(F.explode("left").alias("a"), "high", "low")
                .select(F.col("a.user_id").alias("u"), F.transform(proven, lambda x: F.abs(x["o"] * a)).alias("vs"))
                .where(F.size("vs") > 0))
    rank = F.row_number().over(Window.partitionBy("user_id").orderBy(F.col("sim").desc()))
    return (spread(products, ["u"], tasks).select(F.col("u").alias("user_id"), F.explode("vs").alias("sim"))
            .withColumn("_r", rank).where(F.col("_r") <= k).where(F.col("_r") == k)
            .select("user_id", F.col("sim").alias("_least")))


def near_lists(rows: DataFrame, least: DataFrame, block_size: int, tasks: int) -> DataFrame:
    """``pairs.lists`` of both directions, without the neighbours that are
    proven to lie below the user's bound."""
    known = rows.join(least, "user_id", "left").withColumn(
        "_least", F.coalesce(F.col("_least"), F.lit(float("-inf"))) - F.lit(MARGIN))
    a = F.col("a")
    near = F.filter("right", lambda x: (x["user_id"] != a["user_id"]) & (
        (x["w"] * a["w"] >= a["_least"]) | ~_single(a["_items"], x["_items"])))
    return (P.met(known, ["user_id", "w", "_items", "_least"], block_size, tasks)
            .select(F.explode("left").alias("a"), "right").select("a", near.alias("o"))
            .select(F.col("a.user_id").alias("u"), F.col("a.w").alias("own"),
                    F.col("o.user_id").alias("vs"), F.col("o.w").alias("values"))
            .where(F.size("vs") > 0))


def top_neighbors(profiles: DataFrame, k: int, max_items: int = MAX_ITEMS,
                  heads: int = DEFAULT_HEADS, block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """``neighbors.nearest_neighbors`` of the cosine similarities (both
    directions), from the near pairs alone."""
    load = pair_load(profiles)
    if not P.by_user(profiles, load):
        # they are few and ranking reads them twice, so they are written once
        near = materialize(cosine(near_pairs(profiles, k, max_items, heads, block_size, load)), "near")
        return rank_neighbors(symmetric(near), k, load=load)
    tasks = tasks_for(profiles.sparkSession, load.rows)
    rows = listed(profiles, max_items)
    least = materialize(list_bounds(rows, k, heads, block_size, tasks), "bounds")
    sims = (P.terms(near_lists(rows, least, block_size, tasks), tasks, {"values": "value"})
            .groupBy(F.col("u").alias("user_id"), F.col("v").alias("neighbor_id"))
            .agg(F.sum(F.col("own") * F.col("value")).alias("sim")))
    return ranked(sims, k)
