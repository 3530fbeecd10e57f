from __future__ import annotations

import math
import re

from pyspark.sql import functions as F

from corate.operators import blocks
from corate.operators import pairs as P
from corate.operators import predict as predict_module
from corate.operators.evaluate import lowest_k, mae, mae_by_k
from corate.operators.neighbors import nearest_neighbors
from corate.operators.predict import predict, predict_from, predict_knn, predict_knn_from, predict_with
from corate.operators.ratings import normalize, user_means, user_stats
from tests.conftest import ratings_df, targets_df
from tests.test_pairs import _random_ratings


def _model(spark, rows):
    train = ratings_df(spark, rows)
    stats = user_stats(train)
    prof = normalize(train, stats)
    means = stats.select("user_id", "mean", "n_items")
    pairs = P.co_rating_pairs(prof)
    return prof, means, pairs


def _preds(df):
    return {(r.user_id, r.item_id): r.pred for r in df.collect()}


def test_unknown_user_predicts_zero_and_unknown_item_the_mean(spark):
    rows = [(1, 1, 5), (1, 2, 3), (2, 1, 4), (2, 2, 2), (2, 3, 5)]
    prof, means, pairs = _model(spark, rows)
    targets = targets_df(spark, [(99, 1), (1, 42)])
    got = _preds(predict(targets, prof, means, P.cosine(pairs)))
    assert got[(99, 1)] == 0.0
    assert got[(1, 42)] == 4.0


def test_prediction_formula_on_small_case(spark):
    # user 1 and 2 co-rate items 1, 2; user 2 rated item 3, which user 1 did not.
    rows = [(1, 1, 5), (1, 2, 1), (2, 1, 5), (2, 2, 1), (2, 3, 5)]
    prof, means, pairs = _model(spark, rows)
    sim = P.cosine(pairs).first().sim
    m2 = 11 / 3
    dev23 = (5 - m2) / (5 - m2)
    usws = dev23 * sim / abs(sim)
    expected = 3.0 + usws * (5 - 3.0)
    got = _preds(predict(targets_df(spark, [(1, 3)]), prof, means, P.cosine(pairs)))
    assert math.isclose(got[(1, 3)], expected)


def test_no_neighbour_predicts_user_mean(spark):
    rows = [(1, 1, 5), (1, 2, 1), (2, 3, 4), (2, 4, 2)]
    prof, means, pairs = _model(spark, rows)
    got = _preds(predict(targets_df(spark, [(1, 3)]), prof, means, P.cosine(pairs)))
    assert got[(1, 3)] == 3.0


def test_distinct_terms_collapse_equal_similarities(spark):
    # Users 2 and 3 have the same Jaccard index with user 1 and the same
    # deviation on item 9, so the set-based sums count their term once.
    rows = [(1, 1, 4), (1, 2, 2),
            (2, 1, 5), (2, 3, 1), (2, 9, 5),
            (3, 2, 5), (3, 4, 1), (3, 9, 5),
            (4, 1, 1), (4, 2, 1), (4, 5, 5), (4, 9, 1)]
    prof, means, pairs = _model(spark, rows)
    jac = P.jaccard_pairs(pairs)
    t = targets_df(spark, [(1, 9)])
    plain = _preds(predict(t, prof, means, jac))[(1, 9)]
    distinct = _preds(predict(t, prof, means, jac, distinct_terms=True))[(1, 9)]
    assert plain != distinct
    j12, j14 = 1 / 4, 2 / 4
    d2 = d3 = 1.0
    m4 = 2.0
    d4 = (1 - m4) / (m4 - 1)
    u_plain = (d2 * j12 + d3 * j12 + d4 * j14) / (j12 + j12 + j14)
    u_distinct = (d2 * j12 + d4 * j14) / (j12 + j14)
    mean1 = 3.0

    def denorm(u):
        return mean1 + u * ((5 - mean1) if u > 0 else (mean1 - 1) if u < 0 else 1)
    assert math.isclose(plain, denorm(u_plain))
    assert math.isclose(distinct, denorm(u_distinct))


def test_knn_with_all_neighbours_equals_full_prediction(spark):
    rows = _random_ratings(seed=21, users=30, items=20, density=0.4)
    prof, means, pairs = _model(spark, rows)
    targets = targets_df(spark, [(u, i) for u in range(0, 30, 3) for i in range(20)])
    full = _preds(predict(targets, prof, means, P.cosine(pairs)))
    knn = predict_knn(targets, prof, means, nearest_neighbors(P.cosine(pairs), 100), [100])
    got = {(r.user_id, r.item_id): r.pred_100 for r in knn.collect()}
    assert set(full) == set(got)
    assert all(math.isclose(full[k], got[k], abs_tol=1e-12) for k in full)


def test_half_lists_leave_the_highest_user_without_neighbours(spark):
    rows = [(1, 1, 5), (1, 2, 1), (2, 1, 4), (2, 2, 2), (3, 1, 5), (3, 2, 2), (3, 3, 4)]
    prof, means, pairs = _model(spark, rows)
    half = nearest_neighbors(P.cosine(pairs), 10, symmetric=False)
    assert half.where("user_id = 3").count() == 0
    got = predict_knn(targets_df(spark, [(3, 9)]), prof, means, half, [10]).first()
    assert math.isclose(got.pred_10, 11 / 3)


def test_mae_by_k_and_lowest_k(spark):
    rows = _random_ratings(seed=4, users=30, items=20, density=0.5)
    train = [r for r in rows if (r[0] + r[1]) % 5]
    test = [r for r in rows if (r[0] + r[1]) % 5 == 0]
    prof, means, pairs = _model(spark, train)
    targets = ratings_df(spark, test)
    ks = [2, 5, 50]
    preds = predict_knn(targets, prof, means, nearest_neighbors(P.cosine(pairs), 50), ks)
    by_k = {r.k: r.mae for r in mae_by_k(preds, ks).collect()}
    full = mae(predict(targets, prof, means, P.cosine(pairs))).first().mae
    assert math.isclose(by_k[50], full, abs_tol=1e-12)
    best = lowest_k(mae_by_k(preds, ks), baseline=100.0).first()
    assert best.lowest_k == 2 and math.isclose(best.mae_minus_baseline, by_k[2] - 100.0)
    none = lowest_k(mae_by_k(preds, ks), baseline=0.0).first()
    assert (none.lowest_k, none.mae_minus_baseline) == (-1, -1.0)


def test_predictions_from_profiles_match_those_from_pairs(spark, monkeypatch):
    # Pairs and candidates are dealt by user as lists
    rows = _random_ratings(seed=47, users=50, items=300, density=0.06) + [(u, 999, 3) for u in range(0, 50, 3)]
    ratings = ratings_df(spark, rows + [(77, 5, 4), (77, 6, 4)])  # user 77 has no norm
    profiles = normalize(ratings)
    means = user_means(ratings)
    known = {(u, i) for u, i, _ in rows}
    keys = [(u, i) for u in range(0, 50, 2) for i in range(0, 300, 7) if (u, i) not in known]
    targets = targets_df(spark, keys + keys[:3] + list(known)[:5] + [(77, 999), (12345, 1), (3, 4444)])
    nulls = spark.createDataFrame([(None, 1), (1, None)], targets.schema)
    targets = targets.unionByName(nulls)
    pairs = P.co_rating_pairs(profiles)
    sims = {"a": F.col("dot"), "b": F.col("common").cast("double") / (F.col("n_u") + F.col("n_v") - F.col("common"))}
    ks = [2, 5, 2**31 - 1]

    def found(df):
        return sorted((r.user_id or -1, r.item_id or -1, *[round(x, 8) for x in r[2:]]) for r in df.collect())
    plain = found(predict_with(targets, profiles, means, pairs, sims))
    by_k = found(predict_knn(targets, profiles, means, nearest_neighbors(P.cosine(pairs), ks[-1]), ks))
    assert [r[:3] for r in plain] == [(*r[:2], r[4]) for r in by_k]
    measures = {"a": "cosine", "b": "jaccard"}
    for size in (3, 4096):
        assert found(predict_from(targets, profiles, means, measures, block_size=size)) == plain
    assert found(predict_knn_from(targets, profiles, means, ks)) == by_k
    want = found(predict_with(targets, profiles, means, pairs, {"b": sims["b"]}, True, include_self=True))
    assert found(predict_from(targets, profiles, means, {"b": "jaccard"}, True, include_self=True)) == want
    # a user who meets more others than a task takes: rows are dealt by pair
    monkeypatch.setattr(P, "ROWS_PER_TASK", 100)
    assert found(predict_from(targets, profiles, means, measures)) == plain
    assert found(predict_knn_from(targets, profiles, means, ks)) == by_k


def test_predictions_shuffle_no_row_per_pair(spark):
    profiles = normalize(ratings_df(spark, _random_ratings(seed=41, users=120, items=400, density=0.02)))
    targets = targets_df(spark, [(u, u + 1) for u in range(100)])
    means = profiles.select("user_id", "mean", "n_items").distinct()
    for df in (predict_from(targets, profiles, means, {"pred": "jaccard"}), predict_knn_from(targets, profiles, means, [3])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Exchange hashpartitioning\((u|_lo|least\S*|user_id)#?\w*, ?(v|_hi|_nb|_v|neighbor_id)#", plan)
        assert re.search(r"Exchange hashpartitioning\(u#\d+L, \d+\)", plan)


def test_predictions_in_rounds_of_users_match(spark, monkeypatch):
    # Lists lie on disk for the users of one round
    rows = _random_ratings(seed=53, users=50, items=300, density=0.06) + [(u, 999, 3) for u in range(0, 50, 3)]
    ratings = ratings_df(spark, rows + [(77, 5, 4), (77, 6, 4)])  # user 77 has no norm
    profiles, means = normalize(ratings).cache(), user_means(ratings).cache()
    known = {(u, i) for u, i, _ in rows}
    keys = [(u, i) for u in range(0, 50, 2) for i in range(0, 300, 7)]
    targets = targets_df(spark, keys + keys[:3] + list(known)[:40] + [(77, 999), (77, 5), (12345, 1), (3, 4444)])
    pairs = P.co_rating_pairs(profiles).cache()
    sims = {"a": F.col("dot"), "b": F.col("common").cast("double") / (F.col("n_u") + F.col("n_v") - F.col("common"))}
    ks = [2, 5, 2**31 - 1]

    def found(df):
        return sorted((r.user_id, r.item_id, *[round(x, 8) for x in r[2:]]) for r in df.collect())
    measures = {"a": "cosine", "b": "jaccard"}
    plain = {(d, s): found(predict_with(targets, profiles, means, pairs, sims, d, include_self=s))
             for d, s in ((False, False), (True, False), (False, True))}
    by_k = found(predict_knn(targets, profiles, means, nearest_neighbors(P.cosine(pairs), ks[-1]), ks))
    monkeypatch.setattr(blocks, "ROWS_PER_ROUND", P.pair_load(profiles).rows // 2)
    written = _rounds_written(monkeypatch)
    for (distinct, own), want in plain.items():
        got = predict_from(targets, profiles, means, measures, distinct, include_self=own, block_size=7)
        assert found(got) == want, (distinct, own)
    assert found(predict_knn_from(targets, profiles, means, ks, block_size=7)) == by_k
    assert len(written) == 4 and min(written) > 1


def _rounds_written(monkeypatch):
    """The numbers of rounds that predictions are made in from now on."""
    written, whole = [], predict_module.in_rounds

    def counted(rounds, part, name):
        written.append(rounds)
        return whole(rounds, part, name)
    monkeypatch.setattr(predict_module, "in_rounds", counted)
    return written


def test_rated_targets_shuffle_no_row_per_candidate(spark):
    # sums over the raters of a rated item are made where their lists are dealt
    profiles = normalize(ratings_df(spark, _random_ratings(seed=41, users=120, items=400, density=0.02)))
    means = profiles.select("user_id", "mean", "n_items").distinct()
    df = predict_from(profiles.select("user_id", "item_id"), profiles, means, {"pred": "jaccard"}, include_self=True)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # keys are shuffled for the sums of each, never candidates with a rater's deviation
    dealt = [line for line in plan.splitlines() if re.search(r"Exchange hashpartitioning\(user_id#\d+L, item_id#\d+L, \d+\), REPARTITION", line)]
    assert not dealt and re.search(r"Exchange hashpartitioning\(u#\d+L, \d+\)", plan)
