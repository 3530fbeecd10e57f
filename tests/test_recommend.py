from __future__ import annotations

import math

from corate.operators import blocks
from corate.operators import pairs as P
from corate.operators import recommend as recommend_module
from corate.operators.neighbors import nearest_neighbors
from corate.operators.ratings import normalize, user_stats
from corate.operators.recommend import recommend
from tests.conftest import ratings_df
from tests.test_pairs import _random_ratings


def _brute(spark, rows, catalogue, k, n):
    """Score every unrated catalogue item of every user in Python."""
    df = ratings_df(spark, rows)
    stats = {r.user_id: r.mean for r in user_stats(df).collect()}
    dev = {(r.user_id, r.item_id): r.dev for r in normalize(df).collect()}
    nbrs = {}
    for r in nearest_neighbors(P.cosine(P.co_rating_pairs(normalize(df))), k).collect():
        nbrs.setdefault(r.user_id, []).append((r.neighbor_id, r.sim))
    rated = {(u, i) for u, i, _ in rows}
    out = {}
    for u, mean in stats.items():
        scored = []
        for item in catalogue:
            if (u, item) in rated:
                continue
            terms = [(dev[(v, item)], s) for v, s in nbrs.get(u, []) if (v, item) in dev]
            num = sum(d * s for d, s in terms)
            den = sum(abs(s) for _, s in terms)
            usws = num / den if den else 0.0
            x = mean + usws
            sc = 5 - mean if x > mean else (mean - 1 if x < mean else 1.0)
            scored.append((round(mean + usws * sc, 9), item, mean + usws * sc))
        scored.sort(key=lambda t: (-t[0], t[1]))
        out[u] = [(item, pred) for _, item, pred in scored[:n]]
    return out


def _check(spark, rows, catalogue, k, n):
    items = spark.createDataFrame([(i, f"item {i}") for i in catalogue], "item_id bigint, title string")
    got = {}
    for r in recommend(ratings_df(spark, rows), items, None, k=k, n=n).collect():
        got.setdefault(r.user_id, []).append((r.rank, r.item_id, r.pred, r.title))
    want = _brute(spark, rows, catalogue, k, n)
    assert set(got) == set(want)
    for u, lst in want.items():
        mine = sorted(got[u])
        assert [i for _, i, _, _ in mine] == [i for i, _ in lst], u
        assert all(math.isclose(p, q, abs_tol=1e-9) for (_, _, p, _), (_, q) in zip(mine, lst))
        assert all(t == f"item {i}" for _, i, _, t in mine)


def test_recommend_matches_brute_force(spark):
    rows = _random_ratings(seed=13, users=25, items=30, density=0.3)
    _check(spark, rows, list(range(0, 40)), k=3, n=5)


def test_recommend_fills_with_smallest_uncovered_items(spark):
    # Few neighbours and a sparse catalogue with gaps: many users need
    # items that no neighbour rated (they predict the user's mean).
    rows = _random_ratings(seed=2, users=15, items=12, density=0.25)
    catalogue = [0, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144, 233] + list(range(300, 320))
    _check(spark, [(u, catalogue[i], r) for u, i, r in rows], catalogue, k=1, n=6)


def test_top_n_ties_go_to_smaller_item(spark):
    rows = [(1, 1, 3), (1, 2, 4), (2, 1, 3), (2, 2, 4)]
    items = spark.createDataFrame([(i, str(i)) for i in [9, 7, 1, 2, 5]], "item_id bigint, title string")
    got = [r.item_id for r in recommend(ratings_df(spark, rows), items, None, k=5, n=3)
           .where("user_id = 1").orderBy("rank").collect()]
    assert got == [5, 7, 9]


def test_recommend_for_selected_users(spark):
    rows = _random_ratings(seed=17, users=20, items=25, density=0.3)
    items = spark.createDataFrame([(i, str(i)) for i in range(30)], "item_id bigint, title string")
    users = spark.createDataFrame([(4,), (11,)], "user_id bigint")
    some = {(r.user_id, r.rank): (r.item_id, r.pred)
            for r in recommend(ratings_df(spark, rows), items, users, k=4, n=5).collect()}
    every = {(r.user_id, r.rank): (r.item_id, r.pred)
             for r in recommend(ratings_df(spark, rows), items, None, k=4, n=5)
             .where("user_id in (4, 11)").collect()}
    assert some.keys() == every.keys()
    assert all(some[k][0] == every[k][0] and math.isclose(some[k][1], every[k][1], abs_tol=1e-12)
               for k in some)


def test_unknown_user_gets_smallest_items_at_zero(spark):
    rows = _random_ratings(seed=5, users=10, items=12, density=0.4)
    items = spark.createDataFrame([(i, str(i)) for i in [40, 3, 17, 8, 25, 11]],
                                  "item_id bigint, title string")
    users = spark.createDataFrame([(99,)], "user_id bigint")
    got = [(r.rank, r.item_id, r.pred) for r in
           recommend(ratings_df(spark, rows), items, users, k=3, n=4).orderBy("rank").collect()]
    assert got == [(1, 3, 0.0), (2, 8, 0.0), (3, 11, 0.0), (4, 17, 0.0)]


def test_recommendations_in_rounds_of_users(spark, monkeypatch):
    # the neighbours' items are dealt as lists, for the users of one round;
    # users of more of them than a task takes are dealt by user and item
    rows = _random_ratings(seed=61, users=25, items=200, density=0.5) + [(99, 1, 4), (99, 2, 4)]
    rounds, whole = [], recommend_module.in_rounds

    def counted(n, part, name):
        rounds.append(n)
        return whole(n, part, name)
    monkeypatch.setattr(recommend_module, "in_rounds", counted)
    monkeypatch.setattr(blocks, "ROWS_PER_ROUND", 3000)
    _check(spark, rows, list(range(0, 230)), k=3, n=5)
    monkeypatch.setattr(recommend_module, "ROWS_PER_TASK", 10)
    _check(spark, rows, list(range(0, 230)), k=3, n=5)
    assert len(rounds) == 2 and min(rounds) > 1


def test_covered_items_are_not_written(spark, monkeypatch):
    # of each neighbour's items, only the n best per list are written
    written, whole = [], recommend_module.materialize

    def named(df, name="table"):
        written.append(name)
        return whole(df, name)
    monkeypatch.setattr(recommend_module, "materialize", named)
    rows = _random_ratings(seed=13, users=25, items=30, density=0.3)
    _check(spark, rows, list(range(0, 40)), k=3, n=5)
    assert "best" in written and "covered" not in written
