from __future__ import annotations

import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from corate.config import apply_conf  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    builder = apply_conf(SparkSession.builder.master("local[4]").appName("corate-tests"),
                         shuffle_partitions=8)
    session = builder.config("spark.driver.memory", "4g").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    # Tests set their own checkpoint folder only when the session has none.
    if not session.sparkContext.getCheckpointDir() and not session.conf.get(
            "spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="corate-test-ckpt-"))
    yield session
    session.stop()


def ratings_df(spark, rows):
    """``(user_id, item_id, rating)`` from tuples."""
    return spark.createDataFrame(
        [(int(u), int(i), float(r)) for u, i, r in rows],
        "user_id bigint, item_id bigint, rating double")


def targets_df(spark, rows):
    return spark.createDataFrame([(int(u), int(i)) for u, i in rows],
                                 "user_id bigint, item_id bigint")
