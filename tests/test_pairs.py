from __future__ import annotations

import itertools
import math
import os
import random
import re
import tempfile
import time

from pyspark.sql import functions as F

from corate import config
from corate.config import in_rounds, scratch_path
from corate.operators import blocks
from corate.operators import pairs as P
from corate.operators.neighbors import cosine_neighbors, nearest_neighbors
from corate.operators.predict import predict
from corate.operators.ratings import normalize
from tests.conftest import ratings_df


def _random_ratings(seed=7, users=40, items=25, density=0.35):
    rng = random.Random(seed)
    return [(u, i, rng.randint(1, 5)) for u in range(users) for i in range(items)
            if rng.random() < density]


def _brute_pairs(rows):
    """(u, v) -> (common, cosine) by direct computation in Python."""
    by_user = {}
    for u, i, r in rows:
        by_user.setdefault(u, {})[i] = float(r)
    weights = {}
    for u, items in by_user.items():
        mean = sum(items.values()) / len(items)

        def scale(x):
            return 5 - mean if x > mean else (mean - 1 if x < mean else 1.0)
        dev = {i: (r - mean) / scale(r) for i, r in items.items()}
        norm = math.sqrt(sum(d * d for d in dev.values()))
        weights[u] = {i: (d / norm if norm else None) for i, d in dev.items()}
    out = {}
    for u, v in itertools.combinations(sorted(by_user), 2):
        common = set(by_user[u]) & set(by_user[v])
        if not common:
            continue
        if any(weights[u][i] is None for i in common) or any(weights[v][i] is None for i in common):
            dot = None
        else:
            dot = sum(weights[u][i] * weights[v][i] for i in common)
        out[(u, v)] = (len(common), dot, len(by_user[u]), len(by_user[v]))
    return out


def _collect(pairs_df):
    return {(r.u, r.v): (r.common, r.dot, r.n_u, r.n_v) for r in pairs_df.collect()}


def _assert_same(got, want):
    assert set(got) == set(want)
    for key, (c, d, nu, nv) in want.items():
        gc, gd, gnu, gnv = got[key]
        assert (gc, gnu, gnv) == (c, nu, nv), key
        if d is None:
            assert gd is None
        else:
            assert math.isclose(gd, d, abs_tol=1e-12), key


def test_pairs_match_brute_force(spark):
    rows = _random_ratings()
    got = _collect(P.co_rating_pairs(normalize(ratings_df(spark, rows))))
    _assert_same(got, _brute_pairs(rows))


def test_hot_items_are_split_without_changing_the_result(spark):
    rows = _random_ratings(seed=11, users=60, items=6, density=0.9)
    prof = normalize(ratings_df(spark, rows))
    hot = P.hot_items(prof, block_size=5).collect()
    assert hot and all(r.nb >= 2 for r in hot)
    got = _collect(P.co_rating_pairs(prof, block_size=5))
    _assert_same(got, _brute_pairs(rows))


def test_mixed_hot_and_ordinary_items(spark):
    # Items 0-2 are rated by nearly everyone (split), items 3-9 by few.
    rows = [r for r in _random_ratings(seed=3, users=30, items=10, density=0.9)
            if r[1] < 3 or r[0] % 7 == r[1] % 7]
    prof = normalize(ratings_df(spark, rows))
    assert {r.item_id for r in P.hot_items(prof, block_size=6).collect()} == {0, 1, 2}
    got = _collect(P.co_rating_pairs(prof, block_size=6))
    _assert_same(got, _brute_pairs(rows))


def test_opposite_users_have_similarity_minus_one(spark):
    rows = [(1, 1, 5), (1, 2, 1), (2, 1, 1), (2, 2, 5)]
    sim = P.cosine(P.co_rating_pairs(normalize(ratings_df(spark, rows)))).first()
    assert abs(sim.sim + 1.0) < 1e-9


def test_disjoint_users_have_no_pair(spark):
    rows = [(1, 1, 5), (1, 2, 1), (2, 3, 1), (2, 4, 5)]
    assert P.co_rating_pairs(normalize(ratings_df(spark, rows))).count() == 0


def test_zero_norm_user_has_no_cosine_but_has_jaccard(spark):
    rows = [(1, 1, 3), (1, 2, 3), (2, 1, 5), (2, 2, 1), (2, 3, 2)]
    pairs = P.co_rating_pairs(normalize(ratings_df(spark, rows)))
    assert P.cosine(pairs).count() == 0
    jac = P.jaccard_pairs(pairs).first()
    assert math.isclose(jac.sim, 2 / 3)


def test_similarity_bounds(spark):
    rows = _random_ratings(seed=5)
    pairs = P.co_rating_pairs(normalize(ratings_df(spark, rows)))
    bounds = P.cosine(pairs).agg(F.min("sim"), F.max("sim")).first()
    assert bounds[0] >= -1 - 1e-9 and bounds[1] <= 1 + 1e-9
    jb = P.jaccard_pairs(pairs).agg(F.min("sim"), F.max("sim")).first()
    assert jb[0] > 0 and jb[1] <= 1


def test_similarities_for_matches_symmetric_table(spark):
    rows = _random_ratings(seed=9)
    prof = normalize(ratings_df(spark, rows))
    users = spark.createDataFrame([(3,), (17,)], "user_id bigint")
    got = {(r.user_id, r.neighbor_id): r.sim for r in P.similarities_for(prof, users).collect()}
    full = {(r.user_id, r.neighbor_id): r.sim
            for r in P.symmetric(P.cosine(P.co_rating_pairs(prof))).where("user_id in (3, 17)").collect()}
    assert set(got) == set(full)
    assert all(math.isclose(got[k], full[k], abs_tol=1e-12) for k in got)


def test_load_counts_pair_rows_and_users(spark):
    rows = _random_ratings(seed=4)
    by_item = {}
    for _, i, _ in rows:
        by_item[i] = by_item.get(i, 0) + 1
    assert P.pair_load(ratings_df(spark, rows)) == (sum(d * (d - 1) // 2 for d in by_item.values()), len({u for u, _, _ in rows}))
    assert P.pair_load(ratings_df(spark, [])) == (0, 0)


def test_tasks_follow_the_pair_rows(spark, monkeypatch):
    """Pairs, neighbours and predictions are dealt to as many tasks as their
    rows ask for, whatever the session's number of partitions is."""
    rows = [(u, i, 1 + (u + i) % 5) for u in range(120) for i in range(120) if (u * 31 + i * 17) % 11 == 0]
    profiles = normalize(ratings_df(spark, rows))
    targets = ratings_df(spark, [(u, (u * 7) % 120, 1) for u in range(120)]).select("user_id", "item_id")
    means = profiles.select("user_id", "mean").distinct()

    def results(load):
        pairs = P.co_rating_pairs(profiles, load=load)
        tasks = blocks.tasks_for(spark, load.rows)
        ranked = nearest_neighbors(P.cosine(pairs), 3, load=load)
        return pairs, ranked, predict(targets, profiles, means, P.cosine(pairs), tasks=tasks)

    def sizes(df):
        return [n for n, in spark.createDataFrame(
            df.rdd.mapPartitions(lambda part: [(sum(1 for _ in part),)]), "n long").collect()]

    load = P.pair_load(profiles)
    want = [sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()) for df in results(load)]
    assert want[0] and not load.dense
    monkeypatch.setattr(blocks, "ROWS_PER_TASK", load.rows // 40)
    pairs, ranked, preds = results(load)
    got = [sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()) for df in (pairs, ranked, preds)]
    assert got == want
    assert len(sizes(pairs)) >= 40 and max(sizes(pairs)) < 0.1 * len(want[0])
    # pairs that meet often are added up before the shuffle
    assert P.Load(10**6, 1000).dense is False and P.Load(10**7, 1000).dense is True


def _shuffled_by_pair(df):
    """Exchanges of a plan by two users."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if re.search(r"Exchange hashpartitioning\((u|user_id|_lo)#\d+L?, (v|neighbor_id|_hi)#", line)]


def test_pairs_are_shuffled_as_lists_of_one_user(spark):
    # no row per pair of users is shuffled where no user meets too many
    profiles = normalize(ratings_df(spark, _random_ratings(seed=41, users=120, items=400, density=0.02)))
    for df in (P.co_rating_pairs(profiles), cosine_neighbors(profiles, 3), cosine_neighbors(profiles, 3, symmetric=False)):
        assert not _shuffled_by_pair(df)
    _assert_same(_collect(P.co_rating_pairs(profiles)),
                 _brute_pairs(_random_ratings(seed=41, users=120, items=400, density=0.02)))


def test_lists_of_hot_items_and_row_by_row_agree(spark, monkeypatch):
    rows = _random_ratings(seed=43, users=60, items=300, density=0.08) + [(u, 999, 1 + u % 5) for u in range(60)]
    profiles = normalize(ratings_df(spark, rows))
    assert P.by_user(profiles, P.pair_load(profiles))
    want = _brute_pairs(rows)
    for block_size in (7, 4096):
        _assert_same(_collect(P.co_rating_pairs(profiles, block_size)), want)

    def ranks(df):
        return sorted((r.user_id, r.rank, r.neighbor_id, round(r.sim, 9)) for r in df.collect())
    wanted = {half: ranks(nearest_neighbors(P.cosine(P.co_rating_pairs(profiles)), 4, symmetric=half)) for half in (True, False)}
    for block_size in (7, 4096):
        for half, ranked in wanted.items():
            assert ranks(cosine_neighbors(profiles, 4, half, block_size=block_size)) == ranked
    # a user who meets more others than a task takes: rows are dealt by pair
    monkeypatch.setattr(P, "ROWS_PER_TASK", 1000)
    assert not P.by_user(profiles, P.pair_load(profiles))
    assert _shuffled_by_pair(P.co_rating_pairs(profiles))
    _assert_same(_collect(P.co_rating_pairs(profiles)), want)
    assert ranks(cosine_neighbors(profiles, 4)) == wanted[True]
    assert P.by_user(ratings_df(spark, []), P.Load(0, 0))


def test_pairs_and_neighbours_in_rounds_of_users_match(spark, monkeypatch):
    # lists lie on disk for the users of one round
    rows = _random_ratings(seed=59, users=60, items=300, density=0.08) + [(u, 999, 1 + u % 5) for u in range(60)]
    profiles = normalize(ratings_df(spark, rows + [(77, 5, 4), (77, 6, 4)])).cache()
    load = P.pair_load(profiles)

    def seen(df):
        return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())
    pairs = seen(P.cosine(P.co_rating_pairs(profiles)))
    ranks = {half: seen(cosine_neighbors(profiles, 4, half)) for half in (True, False)}
    monkeypatch.setattr(blocks, "ROWS_PER_ROUND", load.rows // 3)
    for block_size in (7, 4096):
        written = P.written_pairs(profiles, P.cosine, "pairs", block_size, load=load)
        assert len({f.split("/data/")[1].split("/")[0] for f in written.inputFiles()}) > 2
        assert seen(written) == pairs
        for half, want in ranks.items():
            assert seen(cosine_neighbors(profiles, 4, half, block_size=block_size)) == want


def test_a_round_leaves_no_shuffle_files(spark, monkeypatch):
    left = tempfile.mkdtemp()
    monkeypatch.setattr(config, "checkpoint_dir", lambda spark: left)

    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.endswith(".data")}

    def part(at):
        return spark.range(1000).repartition(7, "id").where(f"id % 3 = {at}")
    before = shuffles()
    assert len(in_rounds(3, part, "numbers").collect()) == 1000
    deadline = time.time() + 20
    while shuffles() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not shuffles() - before
    # the session's own setting is as it was
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) != "true"
    # scratch folders are noted for deletion, which needs them to exist
    assert all(os.path.isdir(f"{left}/{name}") for name in os.listdir(left))
    path = scratch_path(spark, "late")
    assert os.path.isdir(os.path.dirname(path)) and not os.path.exists(path)
