from __future__ import annotations

import math

from pyspark.sql import functions as F

from corate.functions import denormalize, normalized_deviation, scale
from corate.operators import checks
from corate.operators.ratings import item_sets, normalize, rater_sets, user_stats
from tests.conftest import ratings_df


def test_scale_branches(spark):
    df = spark.createDataFrame([(4.0, 3.0), (2.0, 3.0), (3.0, 3.0), (1.0, 1.0)], "x double, m double")
    got = [r[0] for r in df.select(scale("x", "m")).collect()]
    assert got == [2.0, 2.0, 1.0, 1.0]


def test_deviation_and_denormalize_round_trip(spark):
    df = spark.createDataFrame([(5.0, 3.5), (1.0, 3.5), (3.5, 3.5)], "r double, m double")
    rows = df.select(normalized_deviation("r", "m").alias("d"),
                     denormalize("m", normalized_deviation("r", "m")).alias("back")).collect()
    assert [r.d for r in rows] == [1.0, -1.0, 0.0]
    assert [r.back for r in rows] == [5.0, 1.0, 3.5]


def test_user_stats_mean_and_norm(spark):
    df = ratings_df(spark, [(1, 1, 5), (1, 2, 3), (1, 3, 1), (2, 1, 4)])
    stats = {r.user_id: r for r in user_stats(df).collect()}
    assert stats[1].mean == 3.0 and stats[1].n_items == 3
    # deviations 1, 0, -1 -> norm sqrt(2)
    assert math.isclose(stats[1].norm, math.sqrt(2.0))
    assert stats[2].norm == 0.0


def test_rating_equal_to_mean_has_zero_norm_and_null_weight(spark):
    df = ratings_df(spark, [(1, 1, 3), (1, 2, 3), (2, 1, 4), (2, 2, 2)])
    rows = normalize(df).where("user_id = 1").collect()
    assert all(r.dev == 0.0 and r.norm == 0.0 and r.w is None for r in rows)


def test_unit_weights_have_unit_norm(spark):
    df = ratings_df(spark, [(1, 1, 5), (1, 2, 2), (1, 3, 4), (1, 4, 1)])
    total = normalize(df).agg(F.sum(F.col("w") * F.col("w"))).first()[0]
    assert math.isclose(total, 1.0)


def test_item_sets_are_paged_and_sorted(spark):
    df = ratings_df(spark, [(1, 3, 1), (1, 1, 1), (1, 2000, 1), (2, 3, 1)])
    sets = {(r.user_id, r.page): list(r.items) for r in item_sets(df).collect()}
    assert sets == {(1, 0): [1, 3], (1, 1): [2000], (2, 0): [3]}
    raters = {(r.item_id, r.page): list(r.users) for r in rater_sets(df).collect()}
    assert raters[(3, 0)] == [1, 2]


def test_duplicate_keys_are_reported(spark):
    df = ratings_df(spark, [(1, 1, 3), (1, 1, 4), (2, 1, 5)])
    row = checks.unique_key_check("dups", df).first()
    assert (row.expected, row.actual, row.ok) == (0, 1, False)


def test_count_check_against_dataframe(spark):
    a = ratings_df(spark, [(1, 1, 3), (2, 1, 4)])
    row = checks.count_check("same", a, a.select("user_id")).first()
    assert (row.expected, row.actual, row.ok) == (2, 2, True)
    row = checks.count_check("fixed", a, 3).first()
    assert (row.expected, row.actual, row.ok) == (3, 2, False)


def test_user_means_and_assert_checks(spark):
    import pytest

    from corate.operators.ratings import user_means
    df = ratings_df(spark, [(1, 1, 4), (1, 2, 2), (2, 1, 5)])
    got = {r.user_id: (r.mean, r.n_items) for r in user_means(df).collect()}
    assert got == {1: (3.0, 2), 2: (5.0, 1)}
    checks.assert_checks(checks.count_check("rows", df, 3))
    with pytest.raises(AssertionError, match="rows expected 4 got 3"):
        checks.assert_checks(checks.count_check("rows", df, 4))
