from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest

from corate.llm import exact_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(LOWER)].append(doc_id)
    out = []
    for doc_id, text in rows:
        t = (text or "").translate(LOWER)
        ids = [i for i in groups[t] if i is not None]
        keep = max(ids) if ids else None
        out.append((doc_id, keep, len(groups[t]), doc_id == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("table_bytes", [500, 1 << 20])
def test_groups_equal_brute_force(spark, odd_docs, table_bytes):
    """With 500 bytes a table every bucket spills, level after level."""
    got = sorted((tuple(r) for r in exact_dedup.exact_groups(odd_docs, table_bytes).collect()), key=repr)
    assert got == brute([(r.doc_id, r.text) for r in odd_docs.collect()])


def test_recursive_spilling_keeps_every_group(spark, docs_df):
    rows = [(i, f"text number {i % 700} {'y' * (i % 50)}") for i in range(3000)]
    got = exact_dedup.exact_groups(docs_df(rows), 2000)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_only_ascii_letters_fold(docs_df):
    got = {r.doc_id: r.keep_id for r in exact_dedup.exact_groups(docs_df([(1, "ÉA"), (2, "éa"), (3, "Éa")])).collect()}
    assert got == {1: 3, 2: 2, 3: 3}


def test_keep_one_keeps_columns_and_one_row_each(odd_docs):
    kept = exact_dedup.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    got = kept.collect()
    want = {k[1] for k in brute([(r.doc_id, r.text) for r in odd_docs.collect()])}
    assert sorted((r.doc_id for r in got), key=repr) == sorted(want, key=repr)


def test_clashing_columns_and_empty_table(spark, docs_df):
    docs = docs_df([(1, "a"), (2, "a")])
    for name in ("digest", "keep_id", "group_size", "kept", "content"):
        docs = docs.selectExpr("*", f"'z' AS {name}")
    assert [r.doc_id for r in exact_dedup.keep_one(docs).collect()] == [2]
    assert exact_dedup.exact_groups(docs).count() == 2
    assert exact_dedup.exact_groups(docs.where("false")).count() == 0
