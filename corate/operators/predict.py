"""Rating prediction from a user's neighbours.

For a target ``(u, i)`` the prediction is

    usws = sum_v dev(v, i) * sim(u, v) / sum_v |sim(u, v)|
    pred = mean_u + usws * scale(mean_u + usws, mean_u)

over the users ``v`` who rated ``i`` and have a similarity with ``u``. An
unknown user has mean ``unknown_user_mean`` (0.0); an item nobody rated,
or one whose raters have no similarity with ``u``, gives ``usws = 0`` and
so the user's mean.

Plan: the distinct keys of the targets are joined with the item's raters on
``item_id`` (an item with many raters and many targets is split into block
pairs, see ``blocks``), then joined with the similarity table on the
canonical pair ``(least, greatest)``, then grouped back per key. Candidates
without a similarity end at that join, and a candidate carries ids and a
deviation only; a placeholder row per key, added behind the join, keeps keys
that nothing is found for and brings the user's mean. ``tasks`` deals
candidates to more tasks than the session's (``blocks.tasks_for``).
The predictions are joined back to all target rows, so a key that occurs in
several rows is scored once and every row is answered.

``predict_from`` and ``predict_knn_from`` take the profiles in place of a pair
table and answer the targets as their similarities are formed. An item's
raters and targets are put in lists (``pairs.met``); the lists that make the
pairs and those that make the candidates are dealt by user in one shuffle, and
the rows of a pair of users meet in one window, which adds up their similarity
for its candidates. Neither the pair table nor the candidates are shuffled row
by row. Lists are dealt in rounds of users (``blocks.rounds_for``), so that the
disk holds those of one round beside what is found in them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corate.config import in_rounds
from corate.functions import (
    RANK_DIGITS,
    RATING_MAX,
    RATING_MIN,
    denormalize,
    jaccard,
    pair_high,
    pair_low,
    rank_key,
    ratio_or_zero,
)
from corate.operators import pairs as P
from corate.operators.blocks import DEFAULT_BLOCK_SIZE, join_split, rounds_for, spread, tasks_for
from corate.operators.neighbors import nearest_neighbors

UNKNOWN_USER_MEAN = 0.0


KEYS = ["user_id", "item_id"]


def _group(cand: DataFrame, *aggs, by: list | None = None) -> DataFrame:
    """Group by the target key and carry the mean, which has one value per
    key; ``max`` picks it up without widening the hash key with a double."""
    return cand.groupBy(*KEYS, *(by or [])).agg(F.max("_mean").alias("_mean"), *aggs)


def _candidates(targets: DataFrame, profiles: DataFrame, block_size: int,
                tasks: int | None) -> DataFrame:
    """One row per distinct target key and other rater of its item."""
    t = targets.select(*KEYS).distinct()
    raters = profiles.select("item_id", F.col("user_id").alias("_nb"), F.col("dev").alias("_ndev"))
    return join_split(t, raters, "item_id", ["user_id"], ["_nb"], block_size, tasks).where(
        F.col("user_id") != F.col("_nb"))


def _placeholders(targets: DataFrame, means: DataFrame, unknown_user_mean: float) -> DataFrame:
    """One row per distinct target key with the user's mean, whose NULLs every
    sum skips: keys that nothing is found for need no outer join."""
    return (targets.select(*KEYS).distinct()
            .join(means.select("user_id", F.col("mean").alias("_mean")), "user_id", "left")
            .withColumn("_mean", F.coalesce(F.col("_mean"), F.lit(unknown_user_mean))))


def _answer(targets: DataFrame, scored: DataFrame) -> DataFrame:
    """All target rows with the predictions of their key (NULL keys too)."""
    names = [c for c in scored.columns if c not in KEYS]
    keyed = scored.select(F.col("user_id").alias("_u"), F.col("item_id").alias("_i"), *names)
    same = targets["user_id"].eqNullSafe(F.col("_u")) & targets["item_id"].eqNullSafe(F.col("_i"))
    return targets.join(keyed, same).drop("_u", "_i")


def _aggregate(cand: DataFrame, sims: Mapping[str, Column],
               distinct_terms: bool, rating_min: float, rating_max: float,
               tasks: int | None) -> DataFrame:
    # dealt by the whole key, which the group and the windows below refine or
    # equal: a key's rows come from as many tasks, so that sums before the
    # shuffle would merge next to none
    cand, terms = _terms(spread(cand, KEYS, tasks), sims, distinct_terms)
    sums = [F.sum(term).alias(name) for name, term in terms.items()]
    return _predicted(_group(cand, *sums), list(sims), rating_min, rating_max)


def _terms(cand: DataFrame, sims: Mapping[str, Column], distinct_terms: bool) -> tuple[DataFrame, dict[str, Column]]:
    """``_num_<name>`` and ``_den_<name>``: what candidates add to their key."""
    terms = {}
    for name, sim in sims.items():
        terms[f"_num_{name}"], terms[f"_den_{name}"] = F.col("_ndev") * sim, F.abs(sim)
    return _first_terms(cand, terms) if distinct_terms else (cand, terms)


def _predicted(summed: DataFrame, names: Sequence[str], rating_min: float, rating_max: float) -> DataFrame:
    return summed.select(*KEYS, *[denormalize("_mean", ratio_or_zero(f"_num_{name}", f"_den_{name}"),
                                              rating_min, rating_max).alias(name) for name in names])


def _first_terms(cand: DataFrame, terms: Mapping[str, Column]
                 ) -> tuple[DataFrame, dict[str, Column]]:
    """Candidates with their terms rounded, and each term where it is the
    first of its value for the target key (NULL elsewhere), so that plain
    sums add distinct values.

    A candidate stays one row, dealt by its target key already; the terms are
    told apart by windows within the key (``sum_distinct`` of several columns
    multiplies every row by their number instead)."""
    out = {}
    for name, term in terms.items():
        cand = cand.withColumn(name, F.round(term, RANK_DIGITS))
        nth = F.row_number().over(Window.partitionBy(*KEYS, name).orderBy("_nb"))
        cand = cand.withColumn(f"{name}_nth", nth)
        out[name] = F.when(F.col(f"{name}_nth") == 1, F.col(name))
    return cand, out


def predict_with(targets: DataFrame, profiles: DataFrame, means: DataFrame,
                 pairs: DataFrame, sims: Mapping[str, Column],
                 distinct_terms: bool = False,
                 unknown_user_mean: float = UNKNOWN_USER_MEAN,
                 rating_min: float = RATING_MIN, rating_max: float = RATING_MAX,
                 include_self: bool = False, block_size: int = DEFAULT_BLOCK_SIZE,
                 tasks: int | None = None) -> DataFrame:
    """Targets plus one prediction column per entry of ``sims``.

    ``pairs`` is a pair table keyed by ``(u, v)`` with ``u < v``; each value
    of ``sims`` is a column expression over it (for instance the cosine and
    the Jaccard index of ``co_rating_pairs``), so several similarity
    measures share one candidate join and one aggregation. A pair row whose
    expression is NULL does not count.

    ``distinct_terms=True`` sums distinct products and distinct absolute
    similarities (rounded to 12 places first), which is what a set-based
    accumulation of the terms computes.

    ``include_self=True`` also counts a target user's own rating of the
    target item, with similarity 1 (the Jaccard index of a user with
    themselves); without it a user is never their own neighbour.
    """
    cand = _candidates(targets, profiles, block_size, tasks)
    right = pairs.select(F.col("u").alias("_lo"), F.col("v").alias("_hi"),
                         *[expr.alias(f"_sim_{name}") for name, expr in sims.items()])
    # the canonical pair is a key of the join, not a column that is shuffled
    joined = cand.join(right, (pair_low("user_id", "_nb") == F.col("_lo"))
                       & (pair_high("user_id", "_nb") == F.col("_hi"))).drop("_lo", "_hi")
    return _scored(targets, profiles, means, joined, list(sims), distinct_terms, unknown_user_mean,
                   rating_min, rating_max, include_self, tasks)


def _scored(targets: DataFrame, profiles: DataFrame, means: DataFrame, joined: DataFrame,
            sims: Sequence[str], distinct_terms: bool, unknown_user_mean: float,
            rating_min: float, rating_max: float, include_self: bool, tasks: int | None) -> DataFrame:
    """The answers from ``joined``, the candidates with their ``_sim_<name>``."""
    if include_self:
        own = profiles.select(*KEYS, F.col("user_id").alias("_nb"), F.col("dev").alias("_ndev"),
                              *[F.lit(1.0).alias(f"_sim_{name}") for name in sims])
        joined = joined.unionByName(own.join(targets.select(*KEYS).distinct(), KEYS, "left_semi"))
    joined = joined.unionByName(_placeholders(targets, means, unknown_user_mean), allowMissingColumns=True)
    found = {name: F.col(f"_sim_{name}") for name in sims}
    return _answer(targets, _aggregate(joined, found, distinct_terms, rating_min, rating_max, tasks))


def _measure(name: str) -> Column:
    """A similarity of a row of ``pairs.co_rating_pairs``."""
    if name == "cosine":
        return F.col("dot")
    if name == "jaccard":
        return jaccard("common", "n_u", "n_v")
    raise ValueError(f"unknown measure {name!r}")


def _asking(targets: DataFrame, profiles: DataFrame) -> DataFrame:
    """Raters and, as ``asked`` rows, the distinct target keys of all items; a
    target user who rated nothing else has no similarity with anyone."""
    counts = profiles.select("user_id", "n_items").distinct()
    asked = targets.select(*KEYS).distinct().join(counts, "user_id")
    return profiles.select(*KEYS, "n_items", "dev", F.lit(False).alias("asked")).unionByName(
        asked.select(*KEYS, "n_items", F.lit(None).cast("double").alias("dev"), F.lit(True).alias("asked")))


def _asking_met(asking: DataFrame, block_size: int, tasks: int | None, kept: bool) -> DataFrame:
    return P.met(asking, ["user_id", "n_items", "dev", "asked"], block_size, tasks, kept)


def _asking_lists(met: DataFrame, both: bool, at: int = 0, rounds: int = 1) -> DataFrame:
    """Candidates as ``pairs.lists`` with ``item_id`` and ``asked``: of a
    target (``asked``) its item's other raters, of a rater its targets, always
    those with larger ids. With ``both``, of targets alone all raters."""
    a = F.col("a.user_id")
    if both:
        met = met.withColumn("left", F.filter("left", lambda x: x["asked"]))
        others = F.filter("right", lambda x: ~x["asked"] & (x["user_id"] != a))
    else:
        others = F.filter("right", lambda x: (x["asked"] != F.col("a.asked")) & (x["user_id"] > a))
    return (P.dealt_round(met.select("item_id", F.explode("left").alias("a"), "right"), at, rounds)
            .select("item_id", "a", others.alias("o"))
            .select("item_id", F.col("a.asked").alias("asked"), a.alias("u"), F.col("a.n_items").alias("n_u"),
                    F.col("a.dev").alias("own"), F.col("o.user_id").alias("vs"), F.col("o.n_items").alias("ns"),
                    F.when(F.col("a.asked"), F.col("o.dev")).alias("values"))
            .where(F.size("vs") > 0))


def predict_from(targets: DataFrame, profiles: DataFrame, means: DataFrame,
                 measures: Mapping[str, str], distinct_terms: bool = False,
                 unknown_user_mean: float = UNKNOWN_USER_MEAN,
                 rating_min: float = RATING_MIN, rating_max: float = RATING_MAX,
                 include_self: bool = False, block_size: int = DEFAULT_BLOCK_SIZE,
                 load: P.Load | None = None) -> DataFrame:
    """``predict_with`` the similarities of all pairs of ``profiles``, formed
    here: ``measures`` names the measure, ``"cosine"`` or ``"jaccard"``, of
    each prediction column. ``block_size`` splits the candidates' items."""
    load = load or P.pair_load(profiles)
    sims = {name: _measure(measure) for name, measure in measures.items()}
    asking = _asking(targets, profiles)
    if not P.by_user(asking, load):
        return predict_with(targets, profiles, means, P.co_rating_pairs(profiles, load=load), sims, distinct_terms,
                            unknown_user_mean, rating_min, rating_max, include_self, block_size,
                            tasks_for(profiles.sparkSession, load.rows))
    if include_self:
        sums = _rated_sums(targets, profiles, measures, sims, distinct_terms, block_size)
        summed = _group(sums.unionByName(_placeholders(targets, means, unknown_user_mean), allowMissingColumns=True),
                        *[F.sum(c).alias(c) for c in sums.columns if c not in KEYS])
        return _answer(targets, _predicted(summed, list(sims), rating_min, rating_max))
    rows = P.pair_load(asking).rows
    rounds = rounds_for(rows)
    tasks = tasks_for(profiles.sparkSession, rows // rounds)
    # a candidate brings the rating counts, and only cosines need weights
    dropped = ["ns"] if "cosine" in measures.values() else ["ns", "own", "values"]
    raters = P.met_raters(profiles, tasks=tasks, kept=rounds > 1)
    askers = _asking_met(asking, block_size, tasks, kept=rounds > 1)

    def part(at: int) -> DataFrame:
        met = P.other_terms(P.rater_lists(raters, at=at, rounds=rounds).drop(*dropped).unionByName(
            _asking_lists(askers, False, at, rounds), allowMissingColumns=True), tasks)
        pair, met_once = Window.partitionBy("u", "v"), F.col("item_id").isNull()
        found = met.select(
            "*", F.sum(F.when(met_once, F.col("own") * F.col("value"))).over(pair).alias("dot"),
            F.count_if(met_once).over(pair).alias("common")).where(F.col("item_id").isNotNull() & (F.col("common") > 0))
        return found.select(
            F.when(F.col("asked"), F.col("u")).otherwise(F.col("v")).alias("user_id"), "item_id",
            F.when(F.col("asked"), F.col("v")).otherwise(F.col("u")).alias("_nb"),
            F.when(F.col("asked"), F.col("value")).otherwise(F.col("own")).alias("_ndev"),
            *[sim.alias(f"_sim_{name}") for name, sim in sims.items()])
    joined = in_rounds(rounds, part, "candidates")
    return _scored(targets, profiles, means, joined, list(sims), distinct_terms, unknown_user_mean,
                   rating_min, rating_max, False, tasks)


def _rated_sums(targets: DataFrame, profiles: DataFrame, measures: Mapping[str, str], sims: Mapping[str, Column],
                distinct_terms: bool, block_size: int) -> DataFrame:
    """``(user_id, item_id, _num_<name>, _den_<name>)``: sums over all raters of
    a target's item, the target user among them, with similarity 1.

    Where users ask for what they rated, a candidate is a pair that meets on
    its item, so nearly all have a similarity. One list of an item's raters
    then serves as both, dealt to the target user, whose sums are made in
    the same task."""
    keys = targets.select(*KEYS).distinct()
    counts = profiles.select("user_id", "n_items").distinct()
    rated = (profiles.select(*KEYS, "n_items", "dev", "w", F.lit(True).alias("rater"))
             .join(keys.withColumn("asked", F.lit(True)), KEYS, "left"))
    rows = rated.withColumn("asked", F.coalesce("asked", F.lit(False))).unionByName(
        keys.join(profiles.select(*KEYS), KEYS, "left_anti").join(counts, "user_id")
        .withColumns({"rater": F.lit(False), "asked": F.lit(True)}), allowMissingColumns=True)
    # both ends of a pair get a list
    load = 2 * P.pair_load(rows).rows
    rounds = rounds_for(load)
    tasks = tasks_for(profiles.sparkSession, load // rounds)
    # only cosines need weights
    weights = ["w"] if "cosine" in measures.values() else []
    met_by = P.met(rows, ["user_id", "n_items", "dev", "rater", "asked", *weights], block_size, tasks, rounds > 1)
    values = {"ns": "n_v", "devs": "_ndev"} | ({"ws": "w_v"} if weights else {})

    def part(at: int) -> DataFrame:
        a = F.col("a.user_id")
        others = F.filter("right", lambda x: x["rater"] & (F.col("a.asked") | (x["user_id"] != a)))
        listed = (P.dealt_round(met_by.select("item_id", F.explode("left").alias("a"), "right"), at, rounds)
                  .select("item_id", "a", others.alias("o"))
                  .select("item_id", a.alias("u"), F.col("a.n_items").alias("n_u"), F.col("a.rater").alias("rater"),
                          F.col("a.asked").alias("asked"), F.col("o.user_id").alias("vs"),
                          F.col("o.n_items").alias("ns"), F.when(F.col("a.asked"), F.col("o.dev")).alias("devs"),
                          *[F.col(f"a.{w}").alias("own") for w in weights],
                          *[F.when(F.col("a.rater"), F.col(f"o.{w}")).alias("ws") for w in weights])
                  .where(F.size("vs") > 0))
        pair = Window.partitionBy("u", "v")
        dot = [F.sum(F.when(F.col("rater"), F.col("own") * F.col("w_v"))).over(pair).alias("dot") for _ in weights]
        found = P.terms(listed, tasks, values).select(
            "*", *dot, F.count_if("rater").over(pair).alias("common")).where(F.col("asked") & (F.col("common") > 0))
        own = F.col("u") == F.col("v")
        cand = found.select(
            F.col("u").alias("user_id"), "item_id", F.col("v").alias("_nb"), "_ndev",
            *[F.when(own, F.lit(1.0)).otherwise(sim).alias(f"_sim_{name}") for name, sim in sims.items()])
        cand, terms = _terms(cand, {name: F.col(f"_sim_{name}") for name in sims}, distinct_terms)
        return cand.groupBy(*KEYS).agg(*[F.sum(term).alias(name) for name, term in terms.items()])
    return in_rounds(rounds, part, "sums")


def predict(targets: DataFrame, profiles: DataFrame, means: DataFrame,
            sim: DataFrame, distinct_terms: bool = False,
            unknown_user_mean: float = UNKNOWN_USER_MEAN,
            rating_min: float = RATING_MIN, rating_max: float = RATING_MAX,
            include_self: bool = False, block_size: int = DEFAULT_BLOCK_SIZE,
            tasks: int | None = None) -> DataFrame:
    """Targets ``(user_id, item_id, ...)`` plus ``pred``, using all neighbours.

    ``sim`` is ``(u, v, sim)`` with ``u < v`` (cosine or Jaccard).
    """
    return predict_with(targets, profiles, means, sim, {"pred": F.col("sim")},
                        distinct_terms, unknown_user_mean, rating_min, rating_max,
                        include_self, block_size, tasks)


def predict_knn(targets: DataFrame, profiles: DataFrame, means: DataFrame,
                neighbors: DataFrame, ks: Sequence[int],
                unknown_user_mean: float = UNKNOWN_USER_MEAN,
                rating_min: float = RATING_MIN, rating_max: float = RATING_MAX,
                block_size: int = DEFAULT_BLOCK_SIZE, tasks: int | None = None) -> DataFrame:
    """Targets plus ``pred_<k>`` for each k, using only the top-k neighbours.

    ``neighbors`` is ``(user_id, neighbor_id, sim, rank)`` ranked to at least
    ``max(ks)``. The top k are chosen per user over all neighbours and then
    limited to those who rated the item. All k share one candidate join and
    one aggregation with a pair of conditional sums per k.
    """
    cand = _candidates(targets, profiles, block_size, tasks)
    ks = sorted(ks)
    nb = neighbors.where(F.col("rank") <= ks[-1]).select(
        F.col("user_id").alias("_u"), F.col("neighbor_id").alias("_v"),
        F.col("sim").alias("_sim"), F.col("rank").alias("_rank"))
    joined = cand.join(nb, (F.col("user_id") == F.col("_u")) & (F.col("_nb") == F.col("_v")))
    return _scored_by_k(targets, means, joined, ks, unknown_user_mean, rating_min, rating_max)


def predict_knn_from(targets: DataFrame, profiles: DataFrame, means: DataFrame, ks: Sequence[int],
                     unknown_user_mean: float = UNKNOWN_USER_MEAN,
                     rating_min: float = RATING_MIN, rating_max: float = RATING_MAX,
                     block_size: int = DEFAULT_BLOCK_SIZE, load: P.Load | None = None) -> DataFrame:
    """``predict_knn`` with the nearest neighbours by the cosine similarities
    of all pairs of ``profiles``, which are formed and ranked here."""
    load = load or P.pair_load(profiles)
    ks = sorted(ks)
    spark = profiles.sparkSession
    asking = _asking(targets, profiles)
    if not P.by_user(asking, load):
        ranked = nearest_neighbors(P.cosine(P.co_rating_pairs(profiles, load=load)), ks[-1], load=load)
        return predict_knn(targets, profiles, means, ranked, ks, unknown_user_mean, rating_min, rating_max,
                           block_size, tasks_for(spark, load.rows))
    rows = load.rows + P.pair_load(asking).rows
    rounds = rounds_for(rows)
    tasks = tasks_for(spark, rows // rounds)
    # users without a norm have no cosine similarity
    raters = P.met_raters(profiles.where(F.col("w").isNotNull()), tasks=tasks, kept=rounds > 1)
    askers = _asking_met(asking, block_size, tasks, kept=rounds > 1)

    def part(at: int) -> DataFrame:
        met = P.other_terms(P.rater_lists(raters, True, at, rounds).drop("n_u", "ns").unionByName(
            _asking_lists(askers, True, at, rounds).drop("n_u", "ns", "asked"),
            allowMissingColumns=True).withColumn("ns", F.lit(None).cast("array<bigint>")), tasks)
        term = F.when(F.col("item_id").isNull(), F.col("own") * F.col("value"))
        sims = met.withColumn("_sim", F.sum(term).over(Window.partitionBy("u", "v"))).where(F.col("_sim").isNotNull())
        # all rows of a neighbour have one rank, that of the neighbour
        best = Window.partitionBy("u").orderBy(F.col("_key").desc(), F.col("v").asc())
        joined = (sims.withColumn("_key", rank_key("_sim")).withColumn("_rank", F.dense_rank().over(best))
                  .where((F.col("_rank") <= ks[-1]) & F.col("item_id").isNotNull())
                  .select(F.col("u").alias("user_id"), "item_id", F.col("value").alias("_ndev"), "_sim", "_rank"))
        return _by_band(joined, ks)
    banded = in_rounds(rounds, part, "bands")
    sums = [F.sum(c).alias(c) for c in banded.columns if c not in KEYS]
    per_key = _group(banded.unionByName(_placeholders(targets, means, unknown_user_mean), allowMissingColumns=True), *sums)
    return _answer_by_k(targets, per_key, ks, rating_min, rating_max)


def _by_band(joined: DataFrame, ks: Sequence[int], *aggs: Column) -> DataFrame:
    """Sums per target key and band of the candidates among the neighbours."""
    banded = joined.withColumn("_band", rank_band("_rank", ks))
    num, den = F.col("_ndev") * F.col("_sim"), F.abs(F.col("_sim"))
    return banded.groupBy(*KEYS).agg(*aggs, *band_sums(num, den, ks))


def _scored_by_k(targets: DataFrame, means: DataFrame, joined: DataFrame, ks: Sequence[int],
                 unknown_user_mean: float, rating_min: float, rating_max: float) -> DataFrame:
    """The answers from ``joined``, the candidates among the neighbours."""
    joined = joined.select(*KEYS, "_ndev", "_sim", "_rank").unionByName(
        _placeholders(targets, means, unknown_user_mean), allowMissingColumns=True)
    per_key = _by_band(joined, ks, F.max("_mean").alias("_mean"))
    return _answer_by_k(targets, per_key, ks, rating_min, rating_max)


def _answer_by_k(targets: DataFrame, per_key: DataFrame, ks: Sequence[int],
                 rating_min: float, rating_max: float) -> DataFrame:
    preds = [denormalize("_mean", ratio_or_zero(f"_num_{j}", f"_den_{j}"),
                         rating_min, rating_max).alias(f"pred_{k}") for j, k in enumerate(ks)]
    return _answer(targets, up_to_band(per_key, ks).select(*KEYS, *preds))


def rank_band(rank: str, ks: Sequence[int]) -> Column:
    """The number of the band ``(ks[b-1], ks[b]]`` that holds a rank."""
    band = F.lit(None).cast("int")
    for b in reversed(range(len(ks))):
        band = F.when(F.col(rank) <= ks[b], F.lit(b)).otherwise(band)
    return band


def band_sums(num: Column, den: Column, ks: Sequence[int]) -> list[Column]:
    """Sums of ``num`` and ``den`` per ``_band``, as columns of one group:
    partial sums leave the map side once per key, whatever the number of k."""
    out = []
    for b in range(len(ks)):
        inside = F.col("_band") == b
        out += [F.sum(F.when(inside, num)).alias(f"_bn_{b}"),
                F.sum(F.when(inside, den)).alias(f"_bd_{b}")]
    return out


def up_to_band(grouped: DataFrame, ks: Sequence[int]) -> DataFrame:
    """``_num_<j>``, ``_den_<j>``: the sums of the bands 0..j, NULL if all are."""
    cols = {}
    for name, source in (("_num", "_bn"), ("_den", "_bd")):
        so_far = None
        for j in range(len(ks)):
            part = F.col(f"{source}_{j}")
            so_far = part if so_far is None else F.coalesce(so_far + part, so_far, part)
            cols[f"{name}_{j}"] = so_far
    return grouped.withColumns(cols)
