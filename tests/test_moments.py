from __future__ import annotations

import random
from itertools import combinations_with_replacement
from statistics import fmean, pstdev

import pytest

from corate.operators.moments import overlap_moments
from tests.conftest import ratings_df


def _ratings(seed, users=40, items=25):
    """One user of all items, one item that most users rate, and the rest."""
    rng = random.Random(seed)
    rows = {(0, i) for i in range(items)} | {(u, 0) for u in range(users) if u % 5}
    rows |= {(u, rng.randrange(items)) for u in range(users) for _ in range(rng.randint(1, 8))}
    return [(u, i, 3.0) for u, i in sorted(rows)]


@pytest.mark.parametrize("heavy", [0, 6, 10_000])
@pytest.mark.parametrize("block_size", [4, 4096])
def test_moments_equal_all_pairs(spark, heavy, block_size):
    rows = _ratings(heavy + block_size)
    lists = {}
    for u, i, _ in rows:
        lists.setdefault(u, set()).add(i)
    overlaps = [len(lists[u] & lists[v]) for u, v in combinations_with_replacement(sorted(lists), 2)]
    got = overlap_moments(ratings_df(spark, rows), heavy, block_size).first()
    assert (got.n_users, got.all_pairs) == (len(lists), len(overlaps))
    assert got.average == pytest.approx(fmean(overlaps), rel=1e-12)
    assert got.stddev == pytest.approx(pstdev(overlaps), rel=1e-9)


def test_no_ratings(spark):
    assert tuple(overlap_moments(ratings_df(spark, [])).first()) == (0, 0, None, None)
