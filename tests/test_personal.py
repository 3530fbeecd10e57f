"""Personal ratings from a CSV file to a list, on any scale, and the
readers' and checks' refusal of bad rows."""

from __future__ import annotations

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from corate.functions import round_half_away
from corate.operators import checks, evaluate, personal
from corate.operators.capacity import pair_overlap_stats
from corate.operators.recommend import recommend, recommend_many
from corate.plans import reports
from corate.sources import files
from corate.sources.report_json import report_to_json
from tests.conftest import ratings_df
from tests.test_pairs import _random_ratings


def _write(text: str) -> str:
    path = os.path.join(tempfile.mkdtemp(prefix="corate-src-"), "input.txt")
    with open(path, "w") as f:
        f.write(text)
    return path


READS = [lambda df: df.count(), lambda df: df.select(df.columns[0]).collect(),
         lambda df: df.select(df.columns[-1]).collect(), lambda df: checks.count_check("rows", df, 3).collect()]


@pytest.mark.parametrize("read", READS)
@pytest.mark.parametrize("line", ["2\tx\t3", "7", "\t1\t2", "1\t2\t"])
def test_bad_ratings_lines_fail_whatever_is_read(spark, read, line):
    with pytest.raises(Exception, match="bad ratings line"):
        read(files.read_ratings_tsv(spark, _write(f"1\t10\t4\n{line}\n3\t3\t3\n")))


@pytest.mark.parametrize("read", READS)
@pytest.mark.parametrize("line", [",B,4", "x,B,4", "1,B,bad", "1,a,2,extra"])
def test_bad_items_lines_fail_whatever_is_read(spark, read, line):
    with pytest.raises(Exception):
        read(files.read_items_csv(spark, _write(f"1,A,4\n{line}\n3,C,\n")))


def test_all_failed_checks_are_named(spark):
    rows = checks.combine([checks.count_check(f"c{i:02d}", spark.range(i), 0) for i in range(26)])
    with pytest.raises(AssertionError) as e:
        checks.assert_checks(rows)
    assert all(f"c{i:02d} expected 0 got {i}" in str(e.value) for i in range(1, 26))
    checks.assert_checks(rows.where("ok"))


def test_personal_checks(spark):
    schema = "item_id bigint, title string, rating double"
    good = spark.createDataFrame([(i, "t", 1.0 + i % 5) for i in range(25)] + [(99, "t", None)], schema)
    assert all(r.ok for r in personal.personal_checks(good).collect())
    bad = spark.createDataFrame([(1, "t", 9.0), (2, "t", -3.0), (2, "t", 4.0)], schema)
    assert {r.check: r.actual for r in personal.personal_checks(bad).collect()} == {
        "personal_ratings_outside_scale": 2, "personal_items_twice": 1, "personal_ratings_missing": 17}
    assert {r.ok for r in personal.personal_checks(bad, -5, 10, least=3).where("check <> 'personal_items_twice'").collect()} == {True}


def test_csv_to_recommendations(spark):
    mine = files.read_items_csv(spark, _write('1,"A, the first",5\n2,B,\n3,C,1\n4,D,\n'))
    rated = ratings_df(spark, [(1, 1, 5), (1, 2, 4), (1, 3, 1), (2, 1, 1), (2, 4, 5), (2, 3, 5)])
    ratings, user = personal.append_personal(rated, mine)
    assert ratings.count() == 8
    got = recommend(ratings, mine.select("item_id", "title"), rated.select(user.alias("user_id")).distinct(), k=2, n=2)
    assert [(r.user_id, r.rank, r.item_id, r.title) for r in got.orderBy("rank").collect()] == [(3, 1, 2, "B"), (3, 2, 4, "D")]
    fixed, _ = personal.append_personal(rated, mine, 77)
    assert fixed.where("user_id = 77").count() == 2


def test_scale_of_zero_to_ten(spark):
    """Ratings stretched to 0..10 give the same lists and stretched
    predictions if the bounds are passed through, in one pass for all k."""
    rows = _random_ratings(seed=4, users=18, items=14, density=0.35)
    items = spark.createDataFrame([(i, str(i)) for i in range(18)], "item_id bigint, title string")
    narrow = recommend_many(ratings_df(spark, rows), items, None, [2, 5], 4)
    wide = recommend_many(ratings_df(spark, [(u, i, (r - 1) * 2.5) for u, i, r in rows]), items, None, [2, 5], 4, 0.0, 0.0, 10.0)
    key = lambda r: (r.k, r.user_id, r["rank"])
    a, b = ({key(r): (r.item_id, r.pred) for r in df.collect()} for df in (narrow, wide))
    assert a.keys() == b.keys()
    for k in a:
        assert a[k][0] == b[k][0] and abs((a[k][1] - 1) * 2.5 - b[k][1]) < 1e-6


def test_report_json_of_an_empty_test_set(spark):
    train = ratings_df(spark, [(1, 1, 4), (1, 2, 2), (2, 1, 5), (2, 2, 1)])
    doc = json.loads(report_to_json(reports.similarity_report(train, train.where("false")), reports.WHOLE_METRICS).first().json)
    assert doc["Q2.3.1"] == {"CosineBasedMae": None, "CosineMinusBaselineDifference": None}
    n = doc["Q2.3.3"]["NumberOfSimilarityComputationsForU1BaseDataset"]
    assert n == 3 and isinstance(n, int)
    knn = json.loads(report_to_json(reports.knn_report(train, train, ks=(1, 2)), reports.WHOLE_METRICS).first().json)
    assert isinstance(knn["Q3.2.3"]["MaximumNumberOfUsersThatCanFitInRam"], int)
    assert isinstance(knn["Q3.2.1"]["MaeForK=1"], float) and isinstance(knn["Q3.2.2"]["MinNumberOfBytesForK=2"], int)


def test_exact_moments_beyond_double_precision(spark):
    big = 3_000_000_001
    means = spark.createDataFrame([(1, big), (2, big)], "user_id long, n_items long")
    pairs = spark.createDataFrame([(1, 2, big)], "u long, v long, common long")
    r = pair_overlap_stats(means, pairs).first()
    assert r.average == big and r.stddev == 0.0


def test_rounding_has_no_largest_value(spark):
    values = [1.2345675, -1.2345675, 3e12 + 0.25, 1e15, 1e300, 0.0, float("inf")]
    got = [r.x for r in spark.createDataFrame([(v,) for v in values], "v double").select(round_half_away("v", 6).alias("x")).collect()]
    assert got[0] == pytest.approx(1.234568, abs=1e-12) and got[1] == -got[0]
    assert got[2:] == pytest.approx(values[2:])


def test_include_self_counts_the_own_rating(spark):
    from corate.operators import pairs as P
    from corate.operators.predict import predict
    from corate.operators.ratings import normalize, user_stats

    df = ratings_df(spark, [(1, 1, 5), (1, 2, 1), (2, 1, 1), (2, 3, 5)])
    stats = user_stats(df)
    profiles = normalize(df, stats)
    sim = P.jaccard_pairs(P.co_rating_pairs(profiles))
    target = spark.createDataFrame([(1, 1)], "user_id bigint, item_id bigint")
    # deviations of item 1: own +1 (similarity 1), user 2 -1 (similarity 1/3)
    usws = (1 * 1 - 1 / 3) / (1 + 1 / 3)
    assert predict(target, profiles, stats, sim, include_self=True).first().pred == pytest.approx(3 + usws * 2)
    assert predict(target, profiles, stats, sim).first().pred == pytest.approx(3 - 2)
    assert evaluate.BASELINE_MAE == 0.7669 and F is not None
