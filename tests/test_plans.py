"""Plan-shape checks over every registered query (built on sf0.001).

No query may contain a cross join in any form, and the pair join must be
an equi-join on (item, bucket pair) with its partial aggregate. Plans are
built with nothing written in between, so each shows all its steps. (In the
plans of one personal user, whose id is a scalar, Spark then folds an
equi-join on that id away; those are checked as they run.)
"""

from __future__ import annotations

import re

import duckdb
import pytest

from corate.operators import indexing, moments, recommend
from corate.plans import context, registry, reports
from corate.plans.context import TestdataContext
from corate.plans.oracle import oracles
from tests.conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
SQL_TYPES = {"LongType()": "BIGINT", "IntegerType()": "INTEGER", "DoubleType()": "DOUBLE",
             "StringType()": "VARCHAR", "BooleanType()": "BOOLEAN"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


MODULES = (context, indexing, moments, recommend, registry, reports)
PERSONAL = {"recommend_personal", "recommend_from_csv", "report_recommend", "report_recommend_json"}


def test_no_cross_joins_and_oracle_types_agree(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    crossed, typed = {}, {}
    sql = oracles()
    for name, build in registry.QUERIES.items():
        with pytest.MonkeyPatch.context() as patch:
            for module in MODULES if name not in PERSONAL else ():
                patch.setattr(module, "materialize", lambda df, name="": df)
            df = build(spark, SF_SMALL)
        plan = _plan(df)
        hits = [f for f in FORBIDDEN if f in plan]
        if hits:
            crossed[name] = hits
        mine = {f.name: SQL_TYPES.get(str(f.dataType), str(f.dataType)) for f in df.schema.fields}
        rel = con.sql(sql[name])
        theirs = {c: str(t) for c, t in zip(rel.columns, rel.types)}
        if mine != theirs:
            typed[name] = (mine, theirs)
    assert not crossed, crossed
    assert not typed, typed


def test_pair_join_is_keyed_by_item_and_bucket_block(spark):
    plan = _plan(TestdataContext(spark, SF_SMALL).pairs)
    assert re.search(r"(SortMergeJoin|ShuffledHashJoin|BroadcastHashJoin) \[item_id[^\]]*blo[^\]]*bhi", plan)
    assert "blo" in plan and "bhi" in plan
    assert "partial_sum" in plan


@pytest.mark.parametrize("name", ["similarity_cost", "knn_storage", "knn_capacity", "user_mean",
                                  "user_norm", "user_item_sets", "item_user_sets"])
def test_single_reader_queries_write_nothing(spark, name, monkeypatch):
    def refuse(df, name=""):
        raise AssertionError("written before the action")
    for module in MODULES:
        monkeypatch.setattr(module, "materialize", refuse)
    registry.QUERIES[name](spark, SF_SMALL)


def test_tables_are_read_by_column(spark):
    plan = _plan(TestdataContext(spark, SF_SMALL).pairs)
    assert "ReadSchema: struct<user_id:bigint,item_id:bigint,n_items:bigint,w:double>" in plan


def test_view_reads_only_needed_columns(spark):
    plan = _plan(TestdataContext(spark, SF_SMALL).train)
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
