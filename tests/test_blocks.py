"""Hot keys: joins and rankings give the same rows however they are split."""

from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corate.operators import pairs as P
from corate.operators.blocks import join_split
from corate.operators.indexing import dense_index
from corate.operators.neighbors import rank_neighbors
from corate.operators.predict import predict, predict_knn
from corate.operators.ratings import normalize, user_stats
from corate.operators.recommend import recommend
from tests.conftest import ratings_df
from tests.test_pairs import _random_ratings


def test_join_split_equals_a_plain_join_and_bounds_a_task(spark):
    left = spark.createDataFrame([(1, i) for i in range(500)] + [(2, 1), (None, 2)], "k long, l long")
    right = spark.createDataFrame([(1, i) for i in range(300)] + [(2, 7), (3, 8), (None, 9)], "k long, r long")
    got = join_split(left, right, "k", ["l"], ["r"], 32)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, left.join(right, "k").collect()))
    sizes = [n for n, in spark.createDataFrame(
        got.rdd.mapPartitions(lambda rows: [(sum(1 for _ in rows),)]), "n long").collect()]
    assert max(sizes) < 0.4 * sum(sizes)


@pytest.mark.parametrize("block", [2, 5])
def test_blocked_predictions_equal_plain_ones(spark, block):
    rows = _random_ratings(seed=3, users=30, items=8, density=0.8)
    df = ratings_df(spark, rows)
    stats = user_stats(df)
    profiles, means = normalize(df, stats), stats.select("user_id", "mean", "n_items")
    targets = spark.createDataFrame([(u, i) for u in range(35) for i in range(9)], "user_id bigint, item_id bigint")
    cos = P.cosine(P.co_rating_pairs(profiles, block))
    plain_cos = P.cosine(P.co_rating_pairs(profiles))
    ranked = rank_neighbors(P.symmetric(plain_cos), 4)

    def table(df):
        return {r[:2]: r[2] for r in df.collect()}

    for a, b in ((predict(targets, profiles, means, cos, block_size=block), predict(targets, profiles, means, plain_cos)),
                 (predict_knn(targets, profiles, means, ranked, [4], block_size=block), predict_knn(targets, profiles, means, ranked, [4]))):
        got, want = table(a), table(b)
        assert got.keys() == want.keys()
        assert all(math.isclose(got[k], want[k], abs_tol=1e-9) for k in want)


@pytest.mark.parametrize("measure", ["cosine", "jaccard"])
def test_similarities_for_equal_the_pair_table(spark, measure):
    df = ratings_df(spark, _random_ratings(seed=8, users=25, items=6, density=0.8))
    profiles = normalize(df)
    pairs = P.co_rating_pairs(profiles)
    sim = P.cosine(pairs) if measure == "cosine" else P.jaccard_pairs(pairs)
    want = {(r.user_id, r.neighbor_id): r.sim for r in P.symmetric(sim).where("user_id < 10").collect()}
    users = spark.range(10).select(F.col("id").alias("user_id"))
    got = {(r.user_id, r.neighbor_id): r.sim for r in P.similarities_for(profiles, users, measure, 3).collect()}
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], abs_tol=1e-12) for k in want)


def test_two_stage_ranking_of_a_hot_user(spark):
    """One user with 6,000 neighbours, k beyond Spark's early limit."""
    rows = [(1, 10 + i, ((i * 7919) % 500) / 500) for i in range(6000)] + [(2, 5, 0.5)]
    df = spark.createDataFrame(rows, "user_id long, neighbor_id long, sim double")
    got = [(r.rank, r.neighbor_id) for r in rank_neighbors(df, 1500).where("user_id = 1").orderBy("rank").collect()]
    want = sorted(((-s, v) for u, v, s in rows if u == 1))[:1500]
    assert got == [(i + 1, v) for i, (_, v) in enumerate(want)]


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_dense_index_without_exchange_reuse(spark, reuse):
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        part = spark.read.parquet("/root/testdata/sf0.1/part.parquet").select(F.col("p_partkey").alias("item_id"))
        index = dense_index(part, "item_id", num_partitions=13)
        got = [r.item_id for r in index.orderBy("idx").collect()]
        assert got == sorted(got) and len(got) == part.count()
        assert index.agg(F.countDistinct("idx"), F.min("idx"), F.max("idx")).first()[:] == (len(got), 0, len(got) - 1)
        items = spark.createDataFrame([(i, str(i)) for i in range(0, 60, 3)], "item_id bigint, title string")
        ratings = ratings_df(spark, [(u, 3 * i, r) for u, i, r in _random_ratings(seed=2, users=12, items=15, density=0.3)])
        recs = sorted((r.user_id, r.rank, r.item_id) for r in recommend(ratings, items, None, k=2, n=5).collect())
        assert len(recs) == 5 * ratings.select("user_id").distinct().count()
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_repeated_targets_are_all_answered(spark):
    df = ratings_df(spark, [(1, 1, 4), (1, 2, 2), (2, 1, 5), (2, 3, 1), (3, 3, 3), (3, 1, 1)])
    stats = user_stats(df)
    targets = spark.createDataFrame([(1, 3, 1.0), (1, 3, 5.0), (1, 3, 5.0), (None, 3, 2.0), (9, None, 2.0)], "user_id bigint, item_id bigint, rating double")
    sim = P.cosine(P.co_rating_pairs(normalize(df, stats)))
    got = predict(targets, normalize(df, stats), stats, sim).collect()
    assert Counter((r.user_id, r.item_id, r.rating) for r in got) == Counter(map(tuple, targets.collect()))
    assert len({r.pred for r in got if r.user_id == 1}) == 1


def test_constant_rater_with_a_rating_that_doubles_cannot_sum(spark):
    df = ratings_df(spark, [(1, 1, 3.3), (1, 2, 3.3), (1, 3, 3.3), (2, 1, 1), (2, 2, 5)])
    r = user_stats(df).where("user_id = 1").first()
    assert r["mean"] == 3.3 and r["norm"] == 0.0
    assert P.cosine(P.co_rating_pairs(normalize(df))).count() == 0
