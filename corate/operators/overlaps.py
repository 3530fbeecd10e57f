"""Overlaps of user pairs, with the items of very active users as bitmaps.

Two users of thousands of items share hundreds: the join on items would form
as many rows for that one pair. The items of users above ``heavy`` ratings
are therefore numbered by popularity and kept as pages of
``64 * PAGE_WORDS`` bits; a pair of such users meets once a page, and the
row counts the bits that both pages hold. Pairs with at least one other user
take the join on items, where a row is dropped in the join if both of its
users are heavy. Popular items get neighbouring numbers, so that the pages
which most users have are full ones.

A page makes every two users who have it meet, whether they share an item of
it or not. Among many items that few users rate, that is far more pairs than
rate one in common, and it grows with the square of the users. So a page is
used only where its users form no more pairs than the raters of its items do
(``dense_pages``); the items of all others take the join on items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate.config import materialize
from corate.operators.blocks import DEFAULT_BLOCK_SIZE, tasks_for
from corate.operators.indexing import dense_index
from corate.operators.pairs import by_pair, pair_load, pair_rows

# Ratings above which a user's items become bitmaps, and words of a page.
HEAVY_ITEMS = 1024
PAGE_WORDS = 8


def numbered_items(ratings: DataFrame) -> DataFrame:
    """``(item_id, page, _at, _d)``: each item's place on a page, by
    popularity, and its number of raters."""
    popularity = ratings.groupBy("item_id").agg((-F.count(F.lit(1))).alias("_d"))
    places = dense_index(popularity.select(F.struct("_d", "item_id").alias("_place")), "_place")
    size = 64 * PAGE_WORDS
    return places.select(F.col("_place.item_id").alias("item_id"),
                         F.floor(F.col("idx") / F.lit(size)).cast("long").alias("page"),
                         (F.col("idx") % size).cast("int").alias("_at"),
                         (-F.col("_place._d")).alias("_d"))


def item_pages(ratings: DataFrame, numbered: DataFrame) -> DataFrame:
    """``(page, user_id, _b0, _b1, ...)``: each user's items as pages of bits."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_at") % 64)
    word = F.floor(F.col("_at") / F.lit(64)).cast("int")
    words = [F.bit_or(F.when(word == j, bit).otherwise(F.lit(0).cast("long"))).alias(f"_b{j}")
             for j in range(PAGE_WORDS)]
    return (ratings.select("item_id", "user_id").join(numbered.drop("_d"), "item_id")
            .groupBy("page", "user_id").agg(*words))


def dense_pages(pages: DataFrame, numbered: DataFrame) -> DataFrame:
    """``(page)`` of pages whose users form no more pairs than the raters of
    their items, item by item."""
    def pairs(n):
        return n.cast("double") * (n - 1)

    on_page = pages.groupBy("page").agg(pairs(F.count(F.lit(1))).alias("_on_page"))
    on_items = numbered.groupBy("page").agg(F.sum(pairs(F.col("_d"))).alias("_on_items"))
    return on_page.join(on_items, "page").where(F.col("_on_page") <= F.col("_on_items")).select("page")


def _shared_bits(a, b):
    """How many items two pages share."""
    return sum((F.bit_count(a(f"_b{j}").bitwiseAND(b(f"_b{j}"))) for j in range(PAGE_WORDS)),
               F.lit(0)).cast("long")


def bitmap_overlaps(ratings: DataFrame, heavy: int = HEAVY_ITEMS,
                    block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """``pairs.co_rated_counts``: ``(u, v, common)`` of every co-rating pair
    ``u < v``."""
    load = pair_load(ratings)
    tasks = tasks_for(ratings.sparkSession, load.rows)
    active = (ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
              .where(F.col("_n") > heavy).select("user_id"))
    numbered = materialize(numbered_items(ratings.join(active, "user_id", "left_semi")), "numbered")
    pages = materialize(item_pages(ratings.join(active, "user_id", "left_semi"), numbered), "pages")
    dense = materialize(dense_pages(pages, numbered), "dense")
    paged = numbered.join(dense, "page", "left_semi").select("item_id", F.lit(True).alias("_paged"))
    zero = F.lit(0).alias("n_items"), F.lit(0).alias("w")
    # a row meets no other on its item if both are heavy and the item paged
    marked = (ratings.select("item_id", "user_id", *zero)
              .join(active.withColumn("_heavy", F.lit(True)), "user_id", "left").join(paged, "item_id", "left")
              .select("item_id", "user_id", "n_items", "w",
                      F.coalesce(F.col("_heavy") & F.col("_paged"), F.lit(False)).alias("_heavy")))
    one = pair_rows(marked, block_size, lambda a, b: ~(a("_heavy") & b("_heavy")),
                    lambda a, b: F.lit(1).cast("long"), tasks=tasks)
    # a page stands in for the item on which users meet
    both = pair_rows(pages.join(dense, "page", "left_semi").select(
                         F.col("page").alias("item_id"), "user_id", *zero,
                         *[f"_b{j}" for j in range(PAGE_WORDS)]),
                     block_size, lambda a, b: _shared_bits(a, b) > 0, _shared_bits, tasks=tasks)
    return by_pair(one.unionByName(both), load).agg(F.sum("prod").alias("common"))
