"""Driver contract and a few registered queries against their DuckDB oracle."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from corate.plans.registry import QUERIES
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def test_entry_runs(spark):
    rows = entry(spark).collect()
    assert len(rows) == 1
    assert abs(rows[0]["cosine_mae"] - 1.289064) < 1e-6


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", ["mae_comparison", "sim_jaccard", "pair_overlap_stats",
                                  "predict_jaccard_distinct", "knn_neighbors", "report_knn",
                                  "check_row_count", "user_item_sets"])
def test_query_matches_oracle(spark, duck, name):
    got = _norm(queries()[name](spark, SF_SMALL).toPandas())
    want = _norm(duck.execute(oracle_sql()[name]).df())
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want)
    pd.testing.assert_frame_equal(got, want, check_dtype=False, atol=1.5e-6, rtol=0)


@pytest.fixture()
def partitions_setting(spark):
    """Sets or unsets spark.sql.shuffle.partitions; restored afterwards."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    yield lambda value: spark.conf.unset("spark.sql.shuffle.partitions") if value is None else \
        spark.conf.set("spark.sql.shuffle.partitions", value)
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_bare_session_plans_every_query(spark, partitions_setting):
    """A session that never set the number of shuffle partitions: the flagship
    query gives its row, and a query of each family builds its plan."""
    partitions_setting(None)
    assert abs(entry(spark).collect()[0]["cosine_mae"] - 1.289064) < 1e-6
    for name in ("src_ratings_tsv", "user_norm", "sim_cosine_blocked", "sim_symmetric", "predict_knn",
                 "knn_lists", "lowest_k", "knn_capacity", "recommend_personal", "check_personal"):
        assert queries()[name](spark, SF_SMALL).schema.fields


def test_shuffle_partitions_of_any_session():
    from corate.operators.blocks import shuffle_partitions

    class Fake:
        """A session whose setting is no number, as some services allow."""
        class conf:
            get = staticmethod(lambda key: "auto")

        class sparkContext:
            defaultParallelism = 12

    assert shuffle_partitions(Fake) == 12


def test_scratch_folder_is_one_that_executors_share(spark):
    from corate.config import qualified_scheme, shared_folder

    assert qualified_scheme(spark, "/tmp") == "file"
    assert shared_folder("file", "local[8]") and shared_folder("file", "local")
    assert not shared_folder("file", "spark://host:7077") and not shared_folder("file", "local-cluster[3,2,1024]")
    assert shared_folder("hdfs", "yarn")
