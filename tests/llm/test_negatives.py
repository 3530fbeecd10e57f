from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from corate.llm import negatives

SCHEMA = "vec_id bigint, label int, embedding array<double>"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute_force(rows, is_anchor, positives, n_negatives, low=80, high=100, scale=256.0):
    """Every anchor against every row, by the definition."""
    usable = [(i, lab, [math.floor(scale * x) for x in v]) for i, lab, v in rows
              if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    product = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    best = lambda found: sorted(found, key=lambda x: (-x[1], x[0] is None, x[0] or 0))
    out = []
    for a, label, v in usable:
        if a is None or not is_anchor(a):
            continue
        own = best((i, product(v, w)) for i, lab, w in usable if lab == label and i != a)[:positives]
        other = best((i, product(v, w)) for i, lab, w in usable if lab != label)
        for p, ps in own:
            inside = [(i, s) for i, s in other if low * ps <= 100 * s <= high * ps][:n_negatives]
            out += [(a, p, r + 1, i, ps, s) for r, (i, s) in enumerate(inside)]
    return sorted(out, key=repr)


def got(frame):
    return sorted((tuple(r) for r in frame.select(*COLUMNS).collect()), key=repr)


def table(rng, n, dims, spread=1.0):
    return [(i, rng.randrange(3), [rng.gauss(0.3, spread) for _ in range(dims)]) for i in range(n)]


@pytest.mark.parametrize("dims, cells, anchor_cells", [(20, 1 << 20, 1 << 20), (20, 200, 50), (1, 10, 4)])
def test_equals_brute_force(spark, monkeypatch, dims, cells, anchor_cells):
    """One block and many, of rows and of anchors; ties by coarse scale."""
    monkeypatch.setattr(negatives, "BLOCK_CELLS", cells)
    rows = table(random.Random(dims), 150, dims)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = negatives.mine(df, F.col("vec_id") % 10 == 0, positives=3, negatives=4, scale=2.0, anchor_cells=anchor_cells)
    want = brute_force(rows, lambda i: i % 10 == 0, 3, 4, scale=2.0)
    assert want and got(found) == want


def test_odd_rows(spark):
    """NULLs, non-finite components, ragged and empty vectors, NULL and
    repeated ids, components too large for sums in doubles, other columns."""
    nan, inf = float("nan"), float("inf")
    rows = table(random.Random(5), 40, 3)
    rows += [(100, None, [1.0, 1.0, 1.0]), (101, 1, None), (102, 1, [1.0, None, 1.0]), (103, 1, [nan, 1.0, 1.0]), (104, 1, [inf, 1.0, 1.0]),
             (105, 1, [0.5]), (106, 2, []), (107, 1, [0.5, 0.5, 0.5, 0.5]), (None, 1, [0.4, 0.4, 0.4]), (None, 2, [0.4, 0.4, 0.4]),
             (7, 1, [0.2, 0.9, 0.1]), (7, 1, [0.2, 0.9, 0.1]), (108, 0, [3.0e6, 2.0e6, -1.0e6]), (109, 1, [2.9e6, 2.0e6, -1.0e6]), (110, 0, [3.1e6, 2.0e6, 0.0])]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS anchor", "2 AS slot", "3 AS score", "4 AS vector", "5 AS anchor_id")
    anchors = (0, 7, 30, 100, 101, 105, 106, 108, 110)
    found = negatives.mine(df, F.col("vec_id").isin(*anchors), positives=4, negatives=6)
    assert got(found) == brute_force(rows, lambda i: i in anchors, 4, 6)


def test_huge_components_are_summed_exactly(spark):
    rows = [(i, i % 2, [2.0**60 + 2.0**(12 + i), 1.0, -(2.0**60)]) for i in range(6)]
    anchors = spark.createDataFrame(rows, SCHEMA)
    assert negatives.mine(anchors, F.col("vec_id") == 0).columns == COLUMNS
    small = [(i, lab, [x / 2**30 for x in v]) for i, lab, v in rows]
    found = negatives.mine(spark.createDataFrame(small, SCHEMA), F.col("vec_id") < 3, scale=1.0, low=0)
    want = brute_force(small, lambda i: i < 3, 5, 5, low=0, scale=1.0)
    assert [r[:4] for r in got(found)] == [r[:4] for r in want]
    assert negatives.mine(anchors, F.col("vec_id") == 0).count() >= 0


def test_empty_tables(spark):
    df = spark.createDataFrame(table(random.Random(1), 5, 2), SCHEMA)
    assert negatives.mine(df.where("false"), F.lit(True)).count() == 0
    none = negatives.mine(df, F.lit(False))
    assert none.count() == 0 and none.columns == COLUMNS
