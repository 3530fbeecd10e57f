from __future__ import annotations

import pytest

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(40_000))


@pytest.fixture(scope="session")
def docs_df(spark):
    """Makes a documents table from (doc_id, text[, lang]) tuples."""
    def make(rows, schema=DOC_SCHEMA):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(full, schema)
    return make


@pytest.fixture(scope="session")
def odd_docs(docs_df):
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    return docs_df([
        (1, None, None), (2, "", "en"), (None, "a null id stands here today", None), (4, LONG), (5, LONG), (6, "   \n\t "),
        (7, "one"), (7, "one"), (8, "ONE"), (9, "éÉ   \U0001f600 café"), (10, "x" * 300_000),
    ])
