"""Registered queries over whole small tables: held-out quality, SQL, and
the pipeline stage by stage."""

from __future__ import annotations

import sys
import zlib
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[2]
sys.path.insert(0, str(ROOT))

import corpus_pipeline  # noqa: E402
from corate.llm import exact_dedup, jaccard, queries, secrets, toxicity  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    c = duckdb.connect()
    for name in ("documents", "pages", "labels", "embeddings", "benchmark"):
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_gives_the_same_rows(spark, connection, name):
    got = queries.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = connection.execute(f"SELECT {', '.join(columns)} FROM ({queries.ORACLES[name]})").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got.select(*columns).collect())


def test_language_of_held_out_rows(spark, connection):
    lang = dict(connection.execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = queries.op9_language_id(spark, SF).collect()
    assert len(rows) == len(lang)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)


def test_toxicity_of_held_out_rows(spark, connection):
    toxic = dict(connection.execute("SELECT doc_id, toxic FROM labels").fetchall())
    rows = queries.op5_toxicity(spark, SF).collect()
    held = [r for r in rows if r.held_out and r.doc_id in toxic]
    assert sum(r.predicted == toxic[r.doc_id] for r in held) >= 0.93 * len(held)


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns and docs.schema["text"].dataType == before.schema["text"].dataType
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "exact dedup":
            assert exact_dedup.exact_groups(docs).where("group_size > 1").count() == 0
            assert exact_dedup.exact_groups(before).where("kept").count() == len(kept[name])
        if name == "n-gram Jaccard join":
            assert jaccard.similar_components(docs, 5, 80).where("component_id <> doc_id").count() == 0
        if name == "secret scans":
            found = secrets.secret_digest(secrets.find_secrets(docs, secrets.fit_markov(before)))
            assert found.where("n_access > 0 or n_hex > 0 or n_assign > 0").count() == 0
            assert kept[name] == kept["n-gram Jaccard join"]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in pieces} == kept["secret scans"]


def test_entry_lists_all_queries(spark):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert set(entry.oracle_sql()) <= names
    assert toxicity.FIT_ROWS > 0
