"""Top-n recommendations from k nearest neighbours.

For a user ``u`` every catalogue item ``u`` has not rated is a candidate.
Its prediction uses ``u``'s top-k neighbours (chosen over all neighbours)
that rated the item; an item none of them rated predicts ``u``'s mean.
The n best go out, ties (after rounding to 9 places) by the smaller item
id.

No user is crossed with the catalogue. Candidates come in two kinds:

* covered items, rated by at least one of the top-k neighbours: reached by
  joining the neighbour lists with the neighbours' ratings, so the work is
  ``k`` times the neighbours' activity;
* uncovered items, which all predict exactly the mean. Only the n smallest
  ids of them can make the list, and only for users whose n-th covered
  item does not beat the mean. For those users the candidates are the
  first n catalogue positions and the n positions after each rated or
  covered item (every run of free positions starts at the front or right
  after an excluded item), found with an equi-join on a dense catalogue
  index; the n smallest free ones are kept.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corate.config import first_row, in_rounds, materialize
from corate.functions import RATING_MAX, RATING_MIN, denormalize, order_key, ratio_or_zero
from corate.operators.blocks import (
    DEFAULT_BLOCK_SIZE, ROWS_PER_TASK, bucket, in_round, join_split, rounds_for, spread, tasks_for)
from corate.operators.incremental import Model, build
from corate.operators.indexing import dense_index
from corate.operators.neighbors import cosine_neighbors, rank_neighbors
from corate.operators.pairs import pair_load, similarities_for
from corate.operators.predict import UNKNOWN_USER_MEAN, band_sums, rank_band, up_to_band


LIST_KEY = ["k", "user_id"]
# Ratings in one list of a user's.
PAGE = 64


def _top(df: DataFrame, n: int) -> DataFrame:
    """The n best rows of each list ``(k, user_id)``."""
    order = Window.partitionBy(*LIST_KEY).orderBy(order_key("pred").desc(),
                                                  F.col("item_id").asc())
    return df.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= n)


def recommend_many(ratings: DataFrame, catalogue: DataFrame, users: DataFrame | None,
                   ks: Sequence[int], n: int = 5,
                   unknown_user_mean: float = UNKNOWN_USER_MEAN,
                   rating_min: float = RATING_MIN, rating_max: float = RATING_MAX,
                   block_size: int = DEFAULT_BLOCK_SIZE, model: Model | None = None) -> DataFrame:
    """``(k, user_id, rank, item_id, title, pred)`` for each k in ``ks``.

    ``ratings`` is ``(user_id, item_id, rating)``; ``catalogue`` is
    ``(item_id, title)``; ``users`` (``user_id``) limits the users served,
    ``None`` serves every user in ``ratings``. Similarities are cosine.

    All k share one join of the ranked neighbours with the neighbours'
    ratings: sums are taken per band of ranks and added up per k. A
    neighbour in many lists is a hot key of that join and is split into
    blocks. What several branches read (normalised ratings, neighbour ranks,
    best lists) is written once to the shared folder; ``ratings`` is read as it
    is. Users are served in rounds where their neighbours' ratings are many. A ``model`` of the ratings (see
    ``incremental``) holds their statistics and profiles already.
    """
    ks = sorted(ks)
    if model is None:
        model = build(ratings, rating_min, rating_max)
    stats, profiles = model.stats, model.profiles
    if users is None:
        targets = stats.select("user_id")
        ranked = cosine_neighbors(profiles, ks[-1], load=pair_load(profiles), block_size=block_size)
    else:
        targets = users.select("user_id").distinct()
        ranked = rank_neighbors(similarities_for(profiles, targets, block_size=block_size), ks[-1])
    # read by each round, and for lists that are open
    banded = materialize(ranked.select("user_id", "neighbor_id", "sim", rank_band("rank", ks).alias("_band")), "ranked")
    rated = profiles.select("user_id", "item_id")
    items = catalogue.select("item_id")
    lists = F.explode(F.array(*[F.lit(k).cast("long") for k in ks])).alias("k")
    means = (targets.join(stats.select("user_id", "mean"), "user_id", "left")
             .select("user_id", F.coalesce(F.col("mean"), F.lit(unknown_user_mean)).alias("mean"), lists))

    # a neighbour's items that the catalogue has, and a user's own
    offered = _paged(profiles.join(items, "item_id", "left_semi"), F.struct("item_id", "dev"), "neighbor_id")
    own = _paged(profiles, F.struct("item_id", F.lit(None).cast("double").alias("dev")), "user_id")
    load, most = _offers(banded, stats)
    rounds = rounds_for(load)
    tasks = tasks_for(ratings.sparkSession, load // rounds)
    by_user = most <= ROWS_PER_TASK
    index = dense_index(items, "item_id")

    def part(at: int) -> DataFrame:
        inside = in_round(F.col("user_id"), at, rounds)

        def of_round(rows: DataFrame) -> DataFrame:
            return rows if inside is None else rows.where(inside)

        def covered(ranked: DataFrame, users: DataFrame) -> DataFrame:
            return _covered(ranked, offered, own.join(users.select("user_id").distinct(), "user_id", "left_semi"),
                            ks, by_user, max(1, block_size // PAGE), tasks)
        return _top_n(covered, of_round(banded), of_round(means), rated, index, n, rating_min, rating_max)
    best = in_rounds(rounds, part, "recommended")
    return best.join(catalogue.select("item_id", "title"), "item_id").select(
        "k", "user_id", "rank", "item_id", "title", "pred")


def _paged(profiles: DataFrame, member: Column, user: str) -> DataFrame:
    """``(<user>, _page, _rows)``: a user's rows in lists of about ``PAGE``."""
    pages = F.ceil(F.col("n_items") / F.lit(PAGE)).cast("int")
    return (profiles.groupBy(F.col("user_id").alias(user), bucket(["item_id"], pages).alias("_page"))
            .agg(F.collect_list(member).alias("_rows")))


def _offers(banded: DataFrame, stats: DataFrame) -> tuple[int, int]:
    """Ratings of all neighbours of all users, and the most that one user's
    neighbours can have."""
    counts = banded.groupBy("neighbor_id").agg(F.count(F.lit(1)).alias("c")).join(
        stats.select(F.col("user_id").alias("neighbor_id"), F.col("n_items").cast("double").alias("m")), "neighbor_id")
    rows, largest = first_row(counts.agg(F.sum(F.col("c") * F.col("m")), F.max("m")))
    longest = first_row(banded.groupBy("user_id").count().agg(F.max("count")))[0]
    return int(rows or 0), int((largest or 0) * (longest or 0))


def _covered(banded: DataFrame, offered: DataFrame, own: DataFrame, ks: Sequence[int], by_user: bool,
             block_size: int, tasks: int) -> DataFrame:
    """``(k, user_id, item_id, num, den)`` of the items that a user's first k
    neighbours rated and the user didn't.

    A neighbour's items travel as lists; they are dealt by user together with
    the user's own, so that a user's sums are made and what is rated dropped
    in one task (by user and item, where a user has more than a task takes)."""
    met = join_split(banded, offered, "neighbor_id", ["user_id"], ["_page"], block_size, tasks).select(
        "user_id", "sim", "_band", F.col("_rows.item_id").alias("_items"), F.col("_rows.dev").alias("_devs"))
    met = met.unionByName(own.select("user_id", F.col("_rows.item_id").alias("_items"),
                                     F.col("_rows.dev").alias("_devs")), allowMissingColumns=True)

    def rows(listed: DataFrame) -> DataFrame:
        return (listed.select("user_id", "sim", "_band", "_devs", F.posexplode("_items").alias("_at", "item_id"))
                .select("user_id", "item_id", "sim", "_band", F.get("_devs", F.col("_at")).alias("_ndev")))
    dealt = rows(spread(met, ["user_id"], tasks)) if by_user else spread(rows(met), ["user_id", "item_id"], tasks)
    num, den = F.col("_ndev") * F.col("sim"), F.abs(F.col("sim"))
    sums = (dealt.groupBy("user_id", "item_id")
            .agg(*band_sums(num, den, ks), F.count_if(F.col("sim").isNull()).alias("_own")).where(F.col("_own") == 0))
    per_k = F.explode(F.array(*[
        F.struct(F.lit(k).cast("long").alias("k"), F.col(f"_num_{j}").alias("num"),
                 F.col(f"_den_{j}").alias("den")) for j, k in enumerate(ks)])).alias("s")
    # an item is covered for k if one of the first k neighbours rated it
    return (up_to_band(sums, ks).select("user_id", "item_id", per_k)
            .select("s.k", "user_id", "item_id", "s.num", "s.den").where(F.col("den").isNotNull()))


def _top_n(covered: Callable[[DataFrame, DataFrame], DataFrame], banded: DataFrame, means: DataFrame,
           rated: DataFrame, index: DataFrame, n: int, rating_min: float, rating_max: float) -> DataFrame:
    """``(k, user_id, rank, item_id, pred)`` from covered scores plus mean fillers.

    ``covered(banded, users)`` gives the covered scores. ``best`` (at most n
    rows per list) and ``open_lists`` are read by several branches, so they are
    written instead of re-ranking all covered items in each. Covered items are
    far more than both: they are not written, but scored again for users with
    an open list, who are few.
    """
    pred = denormalize("mean", ratio_or_zero("num", "den"), rating_min, rating_max)
    scored = covered(banded, means).join(means, LIST_KEY).select(*LIST_KEY, "item_id", pred.alias("pred"))
    best = materialize(_top(scored, n), "best")

    # Lists that can still take an item at the mean.
    summary = best.groupBy(*LIST_KEY).agg(F.count(F.lit(1)).alias("m"),
                                          F.min(order_key("pred")).alias("lowest"))
    open_lists = materialize(
        means.join(summary, LIST_KEY, "left")
        .where(F.col("m").isNull() | (F.col("m") < n) | (F.col("lowest") <= order_key("mean")))
        .select(*LIST_KEY, "mean"), "open")
    keys = open_lists.select(*LIST_KEY)
    excluded = (rated.join(keys, "user_id").select(*LIST_KEY, "item_id")
                .unionByName(covered(banded.join(keys.select("user_id"), "user_id", "left_semi"), keys)
                             .select(*LIST_KEY, "item_id").join(keys, LIST_KEY, "left_semi"))
                .join(index, "item_id"))
    after = (excluded.select(*LIST_KEY, "idx", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step"))
             .select(*LIST_KEY, (F.col("idx") + F.col("step")).alias("idx")))
    front = keys.select(*LIST_KEY, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("idx"))
    free = (after.unionByName(front).distinct()
            .join(index, "idx")
            .join(excluded.select(*LIST_KEY, "item_id"), [*LIST_KEY, "item_id"], "left_anti"))
    first_free = (free.withColumn("r", F.row_number().over(
        Window.partitionBy(*LIST_KEY).orderBy("idx"))).where(F.col("r") <= n))
    filler = first_free.join(open_lists, LIST_KEY).select(
        *LIST_KEY, "item_id", F.col("mean").alias("pred"))
    return _top(best.select(*LIST_KEY, "item_id", "pred").unionByName(filler), n).select(
        *LIST_KEY, "rank", "item_id", "pred")


def recommend(ratings: DataFrame, catalogue: DataFrame, users: DataFrame | None = None,
              k: int = 30, n: int = 5, unknown_user_mean: float = UNKNOWN_USER_MEAN,
              rating_min: float = RATING_MIN, rating_max: float = RATING_MAX,
              block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """``(user_id, rank, item_id, title, pred)``: the n best unrated items.

    See ``recommend_many``; this is the single-k form.
    """
    return recommend_many(ratings, catalogue, users, [k], n, unknown_user_mean,
                          rating_min, rating_max, block_size).drop("k")
