
from __future__ import annotations

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corate.operators import pairs as P
from corate.operators.predict import predict
from corate.operators.ratings import normalize, user_stats
from corate.plans import reports
from corate.plans.context import TestdataContext
from corate.sources.report_json import report_to_json
from tests.conftest import SF_SMALL, ratings_df, targets_df

ratings_tables = st.lists(
    st.tuples(st.integers(0, 12), st.integers(0, 15), st.integers(1, 5)),
    min_size=8, max_size=80, unique_by=lambda t: (t[0], t[1]))


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=ratings_tables)
def test_similarities_and_predictions_stay_in_range(spark, rows):
    df = ratings_df(spark, rows)
    stats = user_stats(df)
    prof = normalize(df, stats)
    pairs = P.co_rating_pairs(prof)
    cos = P.cosine(pairs).agg(F.min("sim"), F.max("sim")).first()
    if cos[0] is not None:
        assert cos[0] >= -1 - 1e-9 and cos[1] <= 1 + 1e-9
    jac = P.jaccard_pairs(pairs).agg(F.min("sim"), F.max("sim")).first()
    if jac[0] is not None:
        assert 0 < jac[0] and jac[1] <= 1
    users = sorted({u for u, _, _ in rows})
    targets = targets_df(spark, [(u, i) for u in users for i in range(16)])
    means = stats.select("user_id", "mean", "n_items")
    for sim in (P.cosine(pairs), P.jaccard_pairs(pairs)):
        lo, hi = predict(targets, prof, means, sim).agg(F.min("pred"), F.max("pred")).first()
        assert 1 - 1e-9 <= lo and hi <= 5 + 1e-9
    overlap = pairs.count() + len(users)
    assert overlap <= len(users) * (len(users) + 1) // 2


def test_similarity_report_as_json(spark):
    c = TestdataContext(spark, SF_SMALL)
    doc = json.loads(report_to_json(reports.similarity_report(c.train, c.test)).first().json)
    assert set(doc) == {"Q2.3.1", "Q2.3.2", "Q2.3.3", "Q2.3.4", "Q2.3.5"}
    assert abs(doc["Q2.3.1"]["CosineBasedMae"] - 1.289064) < 1e-6
    assert abs(doc["Q2.3.2"]["JaccardMae"] - 1.259174) < 1e-6
    stats = doc["Q2.3.4"]["CosineSimilarityStatistics"]
    assert set(stats) == {"min", "max", "average", "stddev"}
    assert abs(stats["average"] - 4.423311) < 1e-6 and stats["max"] == 54.0
    assert doc["Q2.3.5"]["TotalBytesToStoreNonZeroSimilarityComputationsForU1BaseDataset"] == 85928.0
