"""Ways around the full pair join: near pairs, asked pairs, bitmaps, appended
batches, stored layouts and counts in passing, each against the plain way."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from corate.operators import asked, bits, blocks, checks, incremental, neighbors, overlaps, topk
from corate.operators import pairs as P
from corate.operators.predict import predict
from corate.operators.ratings import normalize, user_means
from corate.plans import registry
from corate.sources import stored
from tests.conftest import SF_SMALL, ratings_df, targets_df


def _ratings(seed, users=60, items=40, density=0.2, hot=()):
    """Random ratings; everyone rates the ``hot`` items, close to their mean.
    User 900's ratings are all alike, user 901 rates nothing in common."""
    rng = random.Random(seed)
    rows = [(u, i, rng.choice([1, 2, 4, 5])) for u in range(users) for i in range(items) if rng.random() < density]
    rows += [(u, i, 3) for u in range(users) for i in hot]
    return rows + [(900, i, 4) for i in range(5)] + [(901, 5000, 2), (901, 5001, 5)]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df, digits=9):
    return sorted(tuple(round(x, digits) if isinstance(x, float) else x for x in r) for r in df.collect())


@pytest.mark.parametrize("seed, k, max_items, heads", [(1, 1, 256, 8), (2, 3, 256, 1), (3, 10, 8, 4), (4, 4, 0, 4), (5, 500, 256, 8)])
def test_near_pairs_give_the_same_lists(spark, seed, k, max_items, heads):
    profiles = normalize(ratings_df(spark, _ratings(seed))).cache()
    want = neighbors.nearest_neighbors(P.cosine(P.co_rating_pairs(profiles)), k)
    got = topk.top_neighbors(profiles, k, max_items, heads, block_size=6)
    assert _rows(got.select(*want.columns)) == _rows(want)


def test_a_hot_item_forms_few_near_pairs(spark):
    """An item that everyone rates near their mean: nearly all pairs meet on
    it, and nearly none of them is near."""
    profiles = normalize(ratings_df(spark, _ratings(6, users=150, items=400, density=0.02, hot=[9999]))).cache()
    all_pairs = P.cosine(P.co_rating_pairs(profiles))
    near = topk.near_pairs(profiles, 2)
    assert near.count() < all_pairs.count() / 2
    want = neighbors.nearest_neighbors(all_pairs, 2)
    assert _rows(topk.top_neighbors(profiles, 2).select(*want.columns)) == _rows(want)


@pytest.mark.parametrize("block_size", [4, 4096])
def test_asked_pairs_are_all_that_targets_need(spark, block_size):
    rows = _ratings(7, users=80, items=300, density=0.03)
    ratings = ratings_df(spark, rows)
    profiles, means = normalize(ratings).cache(), user_means(ratings)
    targets = targets_df(spark, [(1, 3), (1, 3), (2, 7), (900, 1), (901, 2), (77777, 1), (3, 99999), (5, 5000)])
    everything = P.co_rating_pairs(profiles).cache()
    some = asked.asked_pairs(targets, profiles, block_size).cache()
    assert some.count() < everything.count() / 4
    assert some.select("u", "v", "common").exceptAll(everything.select("u", "v", "common")).count() == 0
    want = predict(targets, profiles, means, P.cosine(everything))
    assert _rows(predict(targets, profiles, means, P.cosine(some))) == _rows(want)


def test_bit_sets_never_miss(spark):
    rows = spark.range(2000).selectExpr("id % 7 AS user", "id AS member", "CASE id % 7 WHEN 0 THEN 1 WHEN 1 THEN 64 ELSE 8 END AS words")
    sets = bits.bit_sets(rows, "user", "member", "words", "held")
    assert {(r.user, len(r.held)) for r in sets.collect()} == {(0, 1), (1, 64), *((u, 8) for u in range(2, 7))}
    tested = rows.join(sets, "user").select(bits.may_hold(F.col("held"), F.col("member")).alias("hit"))
    assert tested.where("NOT hit").count() == 0
    others = rows.join(sets, "user").where("user = 1").select(bits.may_hold(F.col("held"), F.col("member") + 10**6).alias("hit"))
    assert others.where("hit").count() < others.count() / 4
    assert spark.range(1).select(bits.may_hold(F.lit(None).cast("array<long>"), F.lit(1)).alias("x")).first().x is False


def test_set_sizes(spark):
    got = spark.createDataFrame([(n,) for n in (0, 1, 8, 9, 100, 10**9)], "n long").select(
        bits.words_for(F.col("n"), 8, 256).alias("w")).collect()
    assert [r.w for r in got] == [1, 1, 1, 2, 16, 256]


@pytest.mark.parametrize("heavy", [0, 9, 1000])
def test_bitmap_overlaps_equal_joined_ones(spark, heavy):
    """All users heavy, some, and none; more items than a page has bits."""
    rows = _ratings(8, users=30, items=1500, density=0.02) + [(500 + u, i * 7, 3) for u in range(3) for i in range(200)]
    ratings = ratings_df(spark, rows)
    assert _rows(overlaps.bitmap_overlaps(ratings, heavy, block_size=5)) == _rows(P.co_rated_counts(ratings))


def test_appended_model_equals_a_full_run(spark):
    """A batch with a new user, more ratings of known ones, and a user whose
    ratings become alike no more."""
    rows = _ratings(9)
    batch = [(1000, 1, 5), (1000, 2, 1), (1000, 3, 4), (3, 7777, 2), (4, 7777, 5), (900, 7777, 1)]
    base = incremental.build(ratings_df(spark, rows))
    sims = P.cosine(P.co_rating_pairs(base.profiles))
    model, touched = incremental.append(base, ratings_df(spark, batch))
    full = incremental.build(ratings_df(spark, rows + batch))
    assert {r.user_id for r in touched.collect()} == {1000, 3, 4, 900}
    assert _rows(model.ratings) == _rows(full.ratings)
    assert _rows(model.stats.select(*full.stats.columns)) == _rows(full.stats)
    key = ["user_id", "item_id", "dev", "n_items"]
    assert _rows(model.profiles.select(*key)) == _rows(full.profiles.select(*key))
    want = P.cosine(P.co_rating_pairs(full.profiles))
    assert _rows(incremental.append_similarities(sims, model, touched)) == _rows(want)
    untouched, none = incremental.append(base, ratings_df(spark, []))
    assert none.count() == 0 and _rows(untouched.stats) == _rows(base.stats)


def test_stored_tables_are_joined_without_an_exchange(spark):
    df = registry.sim_cosine_stored(spark, SF_SMALL)
    # the rows of ordinary items are joined as they lie; hot ones (keyed by
    # their blocks too) and pairs are shuffled
    dealt = [x for x in _plan(df).splitlines() if "Exchange" in x and "partitioning" in x]
    assert dealt and all("blo" in x or "hashpartitioning(u" in x for x in dealt), dealt
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # a large table's plan
    try:
        assert "Exchange" not in _plan(normalize(stored.by_key(ratings_df(spark, _ratings(10)), "r", "user_id", 4)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)


def test_distinct_terms_keep_one_row_a_candidate(spark):
    for name in ("predict_cosine_distinct", "predict_jaccard_distinct"):
        assert "Expand" not in _plan(registry.QUERIES[name](spark, SF_SMALL))


def test_counts_are_taken_by_the_write(spark):
    table, counts = checks.counted(spark.range(100).repartition(3), "numbers", rows=F.count(F.lit(1)), even=F.count_if(F.col("id") % 2 == 0))
    assert counts == {"rows": 100, "even": 50} and table.count() == 100
    empty, counts = checks.counted(spark.range(0), "numbers", rows=F.count(F.lit(1)))
    assert counts["rows"] == 0 and empty.count() == 0
    row = checks.known_count_check("c", table, 3, 4).first()
    assert (row.expected, row.actual, row.ok) == (4, 3, False)


def test_list_heads_are_ranked_without_a_union(spark):
    """Both ends of each list, ties by user id, from one ranking: halves that
    are put together by partition fail once a join splits those of one half."""
    rng = random.Random(11)
    rows = [(u, i, float(rng.choice([-2, -1, -0.5, 0, 0.5, 1, 2]))) for u in range(40) for i in range(5)]
    df = spark.createDataFrame([(*r, [1]) for r in rows] + [(99, 1, None, None)],
                               "user_id long, item_id long, w double, _items array<long>")
    heads = topk.list_heads(df, 3)
    want = set()
    for i in range(5):
        for sign in (1, -1):
            end = sorted((-abs(w), u) for u, j, w in rows if j == i and w * sign > 0)[:3]
            want |= {(u, i, sign * -w) for w, u in end}
    assert {(r.user_id, r.item_id, r.w) for r in heads.collect()} == want and heads.columns == df.columns
    assert "Union" not in _plan(heads)


def test_bitmaps_are_used_only_where_they_form_fewer_pairs(spark, monkeypatch):
    """Groups of users with items of their own: their pages make strangers
    meet, more of them the more groups there are. Items that all users of a
    few rate stay on pages."""
    apart = [(g * 10 + u, g * 40 + i, 3) for g in range(60) for u in range(3) for i in range(20)]
    shared = [(u, 90000 + i, 3) for u in range(0, 60, 10) for i in range(512)]
    formed = []
    whole = overlaps.pair_rows

    def counted(*args, **kwargs):
        rows = whole(*args, **kwargs)
        formed.append(rows.count())
        return rows
    monkeypatch.setattr(overlaps, "pair_rows", counted)
    ratings = ratings_df(spark, apart + shared)
    numbered = overlaps.numbered_items(ratings)
    pages = overlaps.item_pages(ratings, numbered)
    assert 0 < overlaps.dense_pages(pages, numbered).count() < numbered.select("page").distinct().count()
    got = overlaps.bitmap_overlaps(ratings, 9)
    assert _rows(got) == _rows(P.co_rated_counts(ratings))
    # 15 pairs on the shared page instead of 7,680; elsewhere no more than
    # the items form
    assert sum(formed) <= 60 * 20 * 3 + 15


@pytest.mark.parametrize("block_size", [6, 4096])
def test_near_lists_and_near_pairs_agree(spark, monkeypatch, block_size):
    # neighbours that can matter are dealt to each user as lists
    profiles = normalize(ratings_df(spark, _ratings(12, hot=[7777]))).cache()
    want = neighbors.nearest_neighbors(P.cosine(P.co_rating_pairs(profiles)), 3)
    rows = topk.listed(profiles)
    least = topk.list_bounds(rows, 3, 8, block_size, 4)
    kept = topk.near_lists(rows, least, block_size, 4).select(F.sum(F.size("vs"))).first()[0]
    assert 0 < kept < 2 * P.pair_load(profiles).rows
    got = topk.top_neighbors(profiles, 3, block_size=block_size)
    assert not [line for line in _plan(got).splitlines() if "Exchange" in line and "_least" in line]
    assert _rows(got.select(*want.columns)) == _rows(want)
    # a user who meets more others than a task takes: pairs are dealt one by one
    monkeypatch.setattr(P, "ROWS_PER_TASK", 100)
    assert _rows(topk.top_neighbors(profiles, 3, block_size=block_size).select(*want.columns)) == _rows(want)


def test_items_of_one_hash_are_never_taken_for_one(spark, monkeypatch):
    """Two users who share two items of one hash: neither row is the pair."""
    monkeypatch.setattr(topk.F, "hash", lambda c: F.col(c) % 2)
    profiles = normalize(ratings_df(spark, [(1, 2, 5), (1, 4, 1), (2, 2, 5), (2, 4, 2), (2, 5, 4), (3, 2, 1), (3, 5, 5)]))
    want = neighbors.nearest_neighbors(P.cosine(P.co_rating_pairs(profiles)), 1)
    assert _rows(topk.top_neighbors(profiles, 1).select(*want.columns)) == _rows(want)


@pytest.mark.parametrize("block_size", [4, 4096])
def test_asked_pairs_in_rounds_of_items(spark, monkeypatch, block_size):
    # the sets that users carry lie on disk for the items of one round
    ratings = ratings_df(spark, _ratings(13, users=80, items=300, density=0.03))
    profiles = normalize(ratings).cache()
    targets = targets_df(spark, [(u, (u * 7) % 300) for u in range(0, 80, 5)])
    want = _rows(asked.asked_pairs(targets, profiles, block_size))
    asked_rows = len(want)
    assert 0 < asked_rows < P.co_rating_pairs(profiles).count()
    monkeypatch.setattr(blocks, "ROWS_PER_ROUND", P.pair_load(profiles).rows // 3)
    rounds, whole = [], asked.in_rounds

    def counted(n, part, name):
        rounds.append(n)
        return whole(n, part, name)
    monkeypatch.setattr(asked, "in_rounds", counted)
    assert _rows(asked.asked_pairs(targets, profiles, block_size)) == want and rounds[0] > 1
    # the same pairs as row by row
    monkeypatch.setattr(P, "ROWS_PER_TASK", 100)
    assert _rows(asked.asked_pairs(targets, profiles, block_size)) == want
