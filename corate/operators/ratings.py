"""Per-user statistics and normalised ratings.

Input everywhere is a ratings DataFrame ``(user_id, item_id, rating)`` with
one row per ``(user_id, item_id)``.

Per-user values are grouped aggregates (partial aggregation before the
shuffle, so a user holding a third of all rows costs one small partial row
per map task) joined back on ``user_id``. A window over ``user_id`` would
put each user's whole group in one task, so none is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate.functions import RATING_MAX, RATING_MIN, normalized_deviation

# Item sets are emitted in pages of consecutive ids so that no output row
# (and no aggregation group) grows with a user's or item's activity.
SET_PAGE_SIZE = 1024


def user_stats(ratings: DataFrame, rating_min: float = RATING_MIN,
               rating_max: float = RATING_MAX) -> DataFrame:
    """``(user_id, mean, n_items, norm)`` from a per-user rating histogram.

    ``norm`` is the L2 norm of the user's normalised deviations over all
    their items. Both need the mean first, so the big table is reduced to
    ``(user_id, rating, count)`` once (a partial aggregate; a user has as
    many rows as distinct rating values) and the two passes run over that
    histogram instead of over the ratings.
    """
    hist = _histogram(ratings)
    means = _means(hist)
    dev = normalized_deviation("rating", "mean", rating_min, rating_max)
    norms = hist.join(means, "user_id").groupBy("user_id").agg(
        F.sqrt(F.sum(F.col("c") * dev * dev)).alias("norm"))
    return means.join(norms, "user_id")


def _histogram(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("user_id", "rating").agg(F.count(F.lit(1)).alias("c"))


def _means(hist: DataFrame) -> DataFrame:
    """A user whose ratings are all alike has exactly that rating as mean;
    their sum divided by their number may differ in the last bit, which
    would make a tiny norm of what is none."""
    average = F.sum(F.col("rating") * F.col("c")) / F.sum("c")
    same = F.min("rating") == F.max("rating")
    return hist.groupBy("user_id").agg(
        F.when(same, F.min("rating")).otherwise(average).alias("mean"),
        F.sum("c").alias("n_items"))


def user_means(ratings: DataFrame) -> DataFrame:
    """``(user_id, mean, n_items)``: average rating and number of ratings."""
    return _means(_histogram(ratings))


def normalize(ratings: DataFrame, stats: DataFrame | None = None,
              rating_min: float = RATING_MIN, rating_max: float = RATING_MAX
              ) -> DataFrame:
    """``(user_id, item_id, rating, mean, n_items, norm, dev, w)``.

    ``dev = (rating - mean) / scale(rating, mean)``, with ``scale`` the room
    left on the rating scale in the direction of the rating, and
    ``w = dev / norm``. ``w`` is NULL for a user whose ratings all equal the
    mean (norm 0): such a user has no cosine similarity with anyone.

    One join of the ratings with the per-user statistics; AQE broadcasts
    the statistics when they are measured small and splits a hot user's
    partition otherwise.
    """
    if stats is None:
        stats = user_stats(ratings, rating_min, rating_max)
    return (ratings.select("user_id", "item_id", "rating")
            .join(stats.select("user_id", "mean", "n_items", "norm"), "user_id")
            .withColumn("dev", normalized_deviation("rating", "mean",
                                                    rating_min, rating_max))
            .withColumn("w", F.try_divide(F.col("dev"), F.col("norm"))))


def _paged_sets(ratings: DataFrame, key: str, member: str, out: str, page_size: int) -> DataFrame:
    page = F.floor(F.col(member) / F.lit(page_size)).cast("long")
    return (ratings.select(key, member, page.alias("page"))
            .groupBy(key, "page")
            .agg(F.count(F.lit(1)).alias("size"),
                 F.array_sort(F.collect_set(member)).alias(out)))


def item_sets(ratings: DataFrame, page_size: int = SET_PAGE_SIZE) -> DataFrame:
    """``(user_id, page, size, items)``: the items a user rated.

    Sorted arrays, one row per page of ``page_size`` consecutive item
    ids; the union of a user's pages is the user's item set.
    """
    return _paged_sets(ratings, "user_id", "item_id", "items", page_size)


def rater_sets(ratings: DataFrame, page_size: int = SET_PAGE_SIZE) -> DataFrame:
    """``(item_id, page, size, users)``: the users who rated an item, paged."""
    return _paged_sets(ratings, "item_id", "user_id", "users", page_size)


def duplicate_keys(ratings: DataFrame) -> DataFrame:
    """``(user_id, item_id, copies)`` for every key that occurs more than once."""
    return (ratings.groupBy("user_id", "item_id")
            .agg(F.count(F.lit(1)).alias("copies"))
            .where(F.col("copies") > 1))
