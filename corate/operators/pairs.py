"""User-user co-rating pairs and the similarities derived from them.

One self-join of the weighted ratings on ``item_id`` yields, per unordered
user pair ``u < v`` with at least one co-rated item, the overlap count and
the cosine dot product; the same rows give the Jaccard index. Every
similarity is therefore one pass over the join.

Hot items. An item rated by ``d`` users produces ``d (d - 1) / 2`` pair
rows. If one item holds a large share of all ratings, a plain join on
``item_id`` sends all of them to one task. Items with more than
``block_size`` raters are split: each rater gets a bucket
``xxhash64(user) mod nb`` and every bucket pair ``(lo, hi)`` becomes its own
join key with bucket ``lo`` on the left and bucket ``hi`` on the right, so
each task sees at most about ``2 * block_size`` raters and the item's pairs
are spread over ``nb (nb + 1) / 2`` tasks. Ordinary items take
a plain self-join on ``item_id``; both joins feed one aggregation. The hot
item list is joined on ``item_id`` without a hint: AQE broadcasts it when
its measured size is small, and otherwise keeps a sort-merge join, whose
partitioning by ``item_id`` the ordinary self-join reuses.

The number of pair rows follows from the items' degrees (``pair_load``). It
sets the number of tasks that form, and of those that add up, the pairs, so
that no task's memory grows with the table. Rows are dealt by ``(u, v)`` as
they are and added up behind the shuffle: where most pairs meet on one item,
a hash table before it would hold every pair and merge none. Only where pairs
meet many times (``DENSE``) are they added up before the shuffle too.

Lists. Where no user meets more others than one task takes (``by_user``), the
rows of a pair need not be shuffled one by one: a rater of an item is dealt by
user id with the list of the raters whom they meet there (``met``), and the
pairs are formed behind the shuffle (``terms``). A pair then takes the other's
id and weight, instead of a row of its own with both ids. Where what is made of
the pairs is small, a large table's lists are dealt in rounds of users
(``blocks.rounds_for``), so that the disk holds those of one round.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corate.config import first_row, in_rounds, materialize
from corate.functions import jaccard
from corate.operators.blocks import (
    DEFAULT_BLOCK_SIZE, ROWS_PER_TASK, bucket, in_round, join_split, rounds_for, spread, tasks_for)

# What a rater row carries into the pair join.
_VALUES = ["n_items", "w"]

# Pair rows per possible pair of users from which rows are added up before
# they are shuffled.
DENSE = 4

# A condition on two raters of one item, or a value of theirs: gets a column
# of either by name.
Keep = Callable[[Callable[[str], Column], Callable[[str], Column]], Column]


class Load(NamedTuple):
    """Pair rows that the raters of all items form, and users."""

    rows: int
    users: int

    @property
    def dense(self) -> bool:
        return self.rows > DENSE * self.users * (self.users - 1) / 2


def pair_load(ratings: DataFrame) -> Load:
    """The load of ``(user_id, item_id)`` rows, from the items' degrees."""
    degree = ratings.groupBy("item_id").agg(F.count(F.lit(1)).cast("double").alias("d"))
    rows = first_row(degree.agg(F.sum(F.col("d") * (F.col("d") - 1) / 2)))[0]
    users = first_row(ratings.agg(F.count_distinct("user_id")))[0]
    return Load(int(rows or 0), users)


def by_user(ratings: DataFrame, load: Load | None = None) -> bool:
    """Whether pairs can be dealt by one of their users alone: no user of these
    ``(user_id, item_id)`` rows meets more others than a task takes, by the
    largest degrees of users and items, and pairs (of ``load``) aren't dense."""
    if load is not None and load.dense:
        return False
    most = [first_row(ratings.groupBy(key).count().agg(F.max("count")))[0] or 0 for key in ("user_id", "item_id")]
    return most[0] * most[1] <= ROWS_PER_TASK


def hot_items(rows: DataFrame, block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """``(item_id, nb)`` for items with more than ``block_size`` raters.

    ``nb`` is the number of buckets the item's raters are hashed into. The
    degree count is a partial aggregate, so a hot item costs one partial
    row per map task.
    """
    degree = rows.groupBy("item_id").agg(F.count(F.lit(1)).alias("degree"))
    return (degree.where(F.col("degree") > block_size)
            .select("item_id",
                    F.ceil(F.col("degree") / F.lit(block_size)).cast("int").alias("nb")))


def _left(name: str) -> Column:
    return F.col(f"a.{name}")


def _right(name: str) -> Column:
    return F.col(f"b.{name}")


def weight_product(a: Callable[[str], Column], b: Callable[[str], Column]) -> Column:
    return a("w") * b("w")


def _pair_rows(a: DataFrame, b: DataFrame, condition: Column, keep: Keep | None,
               prod: Keep) -> DataFrame:
    """``(u, v, n_u, n_v, prod)`` for joined rater rows ``a.*``, ``b.*``.

    ``keep`` is tested in the join itself, before anything is aggregated or
    shuffled; it must say the same of all rows of a pair. ``prod`` is what a
    row adds to its pair."""
    au, bu = F.col("a.user_id"), F.col("b.user_id")
    a_low = au < bu
    if keep is not None:
        condition = condition & keep(_left, _right)
    return a.join(b, condition).select(
        F.least(au, bu).alias("u"),
        F.greatest(au, bu).alias("v"),
        F.when(a_low, F.col("a.n_items")).otherwise(F.col("b.n_items")).alias("n_u"),
        F.when(a_low, F.col("b.n_items")).otherwise(F.col("a.n_items")).alias("n_v"),
        prod(_left, _right).alias("prod"))


def _plain_pairs(rows: DataFrame, keep: Keep | None, prod: Keep, dealt: bool, tasks: int | None) -> DataFrame:
    """Pairs of raters of ordinary items: one join key, ``u < v`` in the join.

    The rows are dealt to a stated number of partitions: they are few bytes
    and many pairs, and merged partitions would form the pairs in one task.
    ``dealt`` rows lie in buckets by item already."""
    rows = rows if dealt else spread(rows, ["item_id"], tasks)
    a, b = rows.alias("a"), rows.alias("b")
    return _pair_rows(a, b, (F.col("a.item_id") == F.col("b.item_id"))
                      & (F.col("a.user_id") < F.col("b.user_id")), keep, prod)


def _blocked_pairs(rows: DataFrame, keep: Keep | None, prod: Keep, tasks: int | None) -> DataFrame:
    """Pairs of raters of hot items, one join key per bucket pair.

    ``rows`` carries ``nb``, the item's bucket count. A block ``(lo, hi)``
    pairs the raters of bucket ``lo``, on the left, with those of bucket
    ``hi``, on the right; a block ``(x, x)`` pairs bucket ``x`` with itself,
    by user id. So a rater in bucket ``bkt`` is a left row of the blocks
    ``(bkt, hi >= bkt)`` and a right row of the blocks ``(lo <= bkt, bkt)``.
    """
    carried = [c for c in rows.columns if c != "nb"]
    bucketed = rows.withColumn("bkt", bucket(["user_id"], F.col("nb")))
    block = ["item_id", "blo", "bhi"]
    a = spread(bucketed.select(
        *carried, F.col("bkt").alias("blo"),
        F.explode(F.sequence(F.col("bkt"), F.col("nb") - 1)).alias("bhi")), block, tasks).alias("a")
    b = spread(bucketed.select(
        *carried, F.explode(F.sequence(F.lit(0), F.col("bkt"))).alias("blo"),
        F.col("bkt").alias("bhi")), block, tasks).alias("b")
    same_block = ((F.col("a.item_id") == F.col("b.item_id"))
                  & (F.col("a.blo") == F.col("b.blo"))
                  & (F.col("a.bhi") == F.col("b.bhi")))
    once = (F.col("a.blo") < F.col("a.bhi")) | (F.col("a.user_id") < F.col("b.user_id"))
    return _pair_rows(a, b, same_block & once, keep, prod)


def pair_rows(rows: DataFrame, block_size: int = DEFAULT_BLOCK_SIZE,
              keep: Keep | None = None, prod: Keep = weight_product,
              dealt: bool = False, tasks: int | None = None) -> DataFrame:
    """``(u, v, n_u, n_v, prod)``: a row per pair of raters of an item.

    ``rows`` is ``(item_id, user_id, n_items, w)`` and what ``keep`` and
    ``prod`` read; ``dealt`` says that they are a table bucketed by item,
    ``tasks`` how many tasks form the pairs.
    Ordinary items take a plain self-join on ``item_id``; hot items (see
    ``hot_items``) take the bucket-block join."""
    hot = hot_items(rows.select("item_id"), block_size)
    ordinary = rows.join(hot, "item_id", "left_anti")
    split = rows.join(hot, "item_id")
    return _plain_pairs(ordinary, keep, prod, dealt, tasks).unionByName(
        _blocked_pairs(split, keep, prod, tasks))


def met(rows: DataFrame, members: Sequence[str], block_size: int = DEFAULT_BLOCK_SIZE,
        tasks: int | None = None, kept: bool = False, dealt: bool = False) -> DataFrame:
    """``(item_id, left, right)``: lists of an item's rows, as structs of the
    ``members`` columns.

    Every two rows of an item (and every row with itself) stand in one
    ``left`` and one ``right`` list, in either order. An ordinary item has
    one row, whose lists are the same; a hot item (see ``hot_items``) has two
    rows per two of its buckets. ``kept`` writes the lists, for several
    readers; ``dealt`` rows are a table bucketed by item."""
    listed = _met_blocks(rows, members, block_size, tasks, dealt)
    if kept:
        listed = materialize(listed, "met")
    # lists that stand apart are met from either side
    turned = F.when(F.col("right").isNull(), F.array(F.struct("left", F.col("left").alias("right")))).otherwise(
        F.array(F.struct("left", "right"), F.struct(F.col("right").alias("left"), F.col("left").alias("right"))))
    return listed.select("item_id", F.explode(turned).alias("m")).select("item_id", "m.left", "m.right")


def _met_blocks(rows: DataFrame, members: Sequence[str], block_size: int, tasks: int | None,
                dealt: bool) -> DataFrame:
    """``met`` with each two buckets of a hot item once, and no ``right`` where
    it is the same as ``left``."""
    rows = rows.where(F.col("item_id").isNotNull() & F.col("user_id").isNotNull())
    hot = hot_items(rows.select("item_id"), block_size)
    none_hot = first_row(hot) is None
    listed = F.collect_list(F.struct(*members))
    same = F.lit(None).cast(rows.select(F.array(F.struct(*members)).alias("x")).schema["x"].dataType).alias("right")
    ordinary = rows if none_hot else rows.join(hot, "item_id", "left_anti")
    whole = ((ordinary if dealt else spread(ordinary, ["item_id"], tasks))
             .groupBy("item_id").agg(listed.alias("left")).select("item_id", "left", same))
    if none_hot:
        return whole
    cut = (rows.join(hot, "item_id").withColumn("bkt", bucket(["user_id"], F.col("nb")))
           .groupBy("item_id", "nb", "bkt").agg(listed.alias("l")))
    block = ["item_id", "blo", "bhi"]
    a = spread(cut.select("item_id", F.col("bkt").alias("blo"),
                          F.explode(F.sequence(F.col("bkt"), F.col("nb") - 1)).alias("bhi"),
                          F.col("l").alias("left")).where(F.col("blo") < F.col("bhi")), block, tasks)
    b = spread(cut.select("item_id", F.explode(F.sequence(F.lit(0), F.col("bkt"))).alias("blo"),
                          F.col("bkt").alias("bhi"), F.col("l").alias("right")).where(F.col("blo") < F.col("bhi")),
               block, tasks)
    apart = a.join(b, block)
    alone = cut.select("item_id", F.col("l").alias("left"), same)
    return whole.unionByName(apart.select("item_id", "left", "right")).unionByName(alone)


def lists(rows: DataFrame, block_size: int = DEFAULT_BLOCK_SIZE, tasks: int | None = None,
          both: bool = False) -> DataFrame:
    """``(u, n_u, own, vs, ns, values)``: a rater ``u`` of an item with their
    ``w`` as ``own``, and the ids, rating counts and ``w`` of its raters with
    larger ids. With ``both`` these are all raters, ``u`` among them."""
    return rater_lists(met_raters(rows, block_size, tasks), both)


def met_raters(rows: DataFrame, block_size: int = DEFAULT_BLOCK_SIZE, tasks: int | None = None,
               kept: bool = False, dealt: bool = False) -> DataFrame:
    """``met`` of the raters, as ``rater_lists`` reads them."""
    return met(rows.select("item_id", "user_id", *_VALUES), ["user_id", *_VALUES], block_size, tasks, kept, dealt)


def rater_lists(met_by: DataFrame, both: bool = False, at: int = 0, rounds: int = 1) -> DataFrame:
    """``lists`` from ``met_raters``, those of the users of a round."""
    others = F.col("right") if both else F.filter("right", lambda x: x["user_id"] > F.col("a.user_id"))
    return list_columns(dealt_round(met_by.select(F.explode("left").alias("a"), "right"), at, rounds)
                        .select("a", others.alias("o")))


def list_columns(rows: DataFrame) -> DataFrame:
    """``lists`` from ``a``, a rater, and ``o``, those met."""
    return (rows.select(F.col("a.user_id").alias("u"), F.col("a.n_items").alias("n_u"), F.col("a.w").alias("own"),
                        F.col("o.user_id").alias("vs"), F.col("o.n_items").alias("ns"), F.col("o.w").alias("values"))
            .where(F.size("vs") > 0))


def dealt_round(rows: DataFrame, at: int, rounds: int) -> DataFrame:
    """The rows whose member ``a`` is a user of round ``at``."""
    inside = in_round(F.col("a.user_id"), at, rounds)
    return rows if inside is None else rows.where(inside)


def terms(listed: DataFrame, tasks: int | None = None, values: Mapping[str, str] | None = None) -> DataFrame:
    """``lists`` dealt by ``u`` to ``tasks``, with a row per member ``v`` of a
    list: its ``n_v`` and ``value`` in place of ``vs``, ``ns`` and ``values``.
    Other lists of values are named in ``values`` (list to value)."""
    values = values or {"ns": "n_v", "values": "value"}
    kept = [c for c in listed.columns if c != "vs" and c not in values]
    return (spread(listed, ["u"], tasks)
            .select(*kept, *values, F.posexplode("vs").alias("_at", "v"))
            .select(*kept, "v", *[F.get(c, F.col("_at")).alias(name) for c, name in values.items()]))


def other_terms(listed: DataFrame, tasks: int | None = None) -> DataFrame:
    """``terms`` of two different users."""
    return terms(listed, tasks).where(F.col("u") != F.col("v"))


def by_pair(rows: DataFrame, load: Load):
    """``rows`` of ``(u, v, ...)`` grouped by pair, in tasks that follow the load."""
    dealt = rows if load.dense else spread(rows, ["u", "v"], tasks_for(rows.sparkSession, load.rows))
    return dealt.groupBy("u", "v")


def co_rating_pairs(profiles: DataFrame, block_size: int = DEFAULT_BLOCK_SIZE,
                    carried: Sequence[str] = (), keep: Keep | None = None,
                    dealt: bool = False, load: Load | None = None) -> DataFrame:
    """``(u, v, common, dot, n_u, n_v)`` for every co-rating pair ``u < v``.

    ``profiles`` needs ``user_id, item_id, n_items, w`` (see
    ``ratings.normalize``). ``common`` is the number of co-rated items,
    ``dot`` the sum of ``w_u * w_v`` over them (the cosine similarity, since
    ``w`` is unit-normalised; NULL when either user has norm 0) and
    ``n_u``/``n_v`` the users' rating counts.

    ``keep`` limits the pairs (see ``asked`` and ``topk``); ``carried`` are
    the columns of ``profiles`` that it reads. ``load`` is the profiles'
    ``pair_load``, which is taken here if it isn't given.
    """
    load = load or pair_load(profiles)
    rows = profiles.select("item_id", "user_id", *_VALUES, *carried)
    tasks = tasks_for(profiles.sparkSession, load.rows)
    if keep is None and by_user(profiles, load):
        return pairs_of(rater_lists(met_raters(rows, block_size, tasks, dealt=dealt)), tasks)
    return _added_up(by_pair(pair_rows(rows, block_size, keep, dealt=dealt, tasks=tasks), load))


def pairs_of(listed: DataFrame, tasks: int) -> DataFrame:
    """``co_rating_pairs`` from half ``lists``."""
    return _added_up(other_terms(listed, tasks).withColumn("prod", F.col("own") * F.col("value")).groupBy("u", "v"))


def _added_up(grouped) -> DataFrame:
    return grouped.agg(
        F.count(F.lit(1)).alias("common"),
        F.sum("prod").alias("dot"),
        F.max("n_u").alias("n_u"),
        F.max("n_v").alias("n_v"))


def written_pairs(profiles: DataFrame, select: Callable[[DataFrame], DataFrame], name: str,
                  block_size: int = DEFAULT_BLOCK_SIZE, dealt: bool = False, load: Load | None = None,
                  always: bool = False) -> DataFrame:
    """``select(co_rating_pairs(profiles, block_size))``, written in rounds of
    users where the pairs are many, so that their lists don't lie on disk
    beside them. A table of one round is written if it is ``always`` to be."""
    load = load or pair_load(profiles)
    rounds = rounds_for(load.rows)
    if rounds == 1 or not by_user(profiles, load):
        pairs = select(co_rating_pairs(profiles, block_size, dealt=dealt, load=load))
        return materialize(pairs, name) if always else pairs
    tasks = tasks_for(profiles.sparkSession, load.rows // rounds)
    met_by = met_raters(profiles, block_size, tasks, kept=True, dealt=dealt)
    # sorted ids take fewer bytes
    return in_rounds(rounds, lambda at: select(pairs_of(rater_lists(met_by, at=at, rounds=rounds), tasks))
                     .sortWithinPartitions("u", "v"), name)


def co_rated_counts(ratings: DataFrame, block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """``(u, v, common)`` straight from ``(user_id, item_id)``: no statistics,
    norms or weights are computed for a mere count."""
    load = pair_load(ratings)
    rows = ratings.select("item_id", "user_id", F.lit(0).alias("n_items"), F.lit(0).alias("w"))
    tasks = tasks_for(ratings.sparkSession, load.rows)
    if by_user(ratings, load):
        grouped = other_terms(lists(rows, block_size, tasks), tasks).groupBy("u", "v")
    else:
        grouped = by_pair(pair_rows(rows, block_size, tasks=tasks), load)
    return grouped.agg(F.count(F.lit(1)).alias("common"))


def co_rated(pairs: DataFrame) -> DataFrame:
    """``(u, v, common)``."""
    return pairs.select("u", "v", "common")


def cosine(pairs: DataFrame) -> DataFrame:
    """``(u, v, sim)``: cosine similarity of normalised deviations, ``u < v``."""
    return pairs.where(F.col("dot").isNotNull()).select(
        "u", "v", F.col("dot").alias("sim"))


def jaccard_pairs(pairs: DataFrame) -> DataFrame:
    """``(u, v, sim)``: Jaccard index of the users' item sets, ``u < v``.

    Pairs without a co-rated item have index 0 and add nothing to any
    weighted sum, so they are not listed.
    """
    return pairs.select("u", "v", jaccard("common", "n_u", "n_v").alias("sim"))


def symmetric(sim: DataFrame) -> DataFrame:
    """``(user_id, neighbor_id, sim)`` in both orientations of each pair.

    Both rows come from one pass over the pair table (an explode, not a
    union of two reads, which would plan the pair table twice).
    """
    both = F.explode(F.array(
        F.struct(F.col("u").alias("user_id"), F.col("v").alias("neighbor_id")),
        F.struct(F.col("v").alias("user_id"), F.col("u").alias("neighbor_id"))))
    return sim.select(both.alias("o"), "sim").select("o.user_id", "o.neighbor_id", "sim")


def similarities_for(profiles: DataFrame, users: DataFrame,
                     measure: str = "cosine",
                     block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """``(user_id, neighbor_id, sim)`` for the given users only.

    Joins just the target users' rows with all rows on ``item_id`` instead
    of building the whole pair table; used when a few users are scored.
    Nothing bounds ``users``, so hot items are split into blocks.
    ``measure`` is ``"cosine"`` or ``"jaccard"``.
    """
    left = profiles.select("item_id", "user_id", "n_items", "w").join(
        users.select("user_id").distinct(), "user_id", "left_semi")
    right = profiles.select("item_id", F.col("user_id").alias("neighbor_id"),
                            F.col("n_items").alias("_n"), F.col("w").alias("_w"))
    joined = join_split(left, right, "item_id", ["user_id"], ["neighbor_id"], block_size).where(
        F.col("user_id") != F.col("neighbor_id"))
    grouped = joined.groupBy("user_id", "neighbor_id").agg(
        F.count(F.lit(1)).alias("common"),
        F.sum(F.col("w") * F.col("_w")).alias("dot"),
        F.max("n_items").alias("n_u"),
        F.max("_n").alias("n_v"))
    if measure == "cosine":
        return grouped.where(F.col("dot").isNotNull()).select(
            "user_id", "neighbor_id", F.col("dot").alias("sim"))
    if measure == "jaccard":
        return grouped.select("user_id", "neighbor_id",
                              jaccard("common", "n_u", "n_v").alias("sim"))
    raise ValueError(f"unknown measure {measure!r}")
