from __future__ import annotations

import random

import numpy as np
import pytest

from corate.llm import common


@pytest.mark.parametrize("limit", [1, 7, 64, 1 << 20])
def test_word_hashes_do_not_depend_on_slices_or_place(monkeypatch, limit):
    rng = random.Random(1)
    table = common.byte_table(common.BLANKS)
    texts = [" ".join("".join(rng.choices("abé", k=rng.randint(1, 12))) for _ in range(rng.randint(0, 20))).encode() for _ in range(40)]
    texts += [b"", b" ", b"x" * 500, "é   \x0b\x1c".encode()]
    whole = common.Words(texts, table)
    monkeypatch.setattr(common, "SLICE_BYTES", limit)
    sliced = common.Words(texts, table)
    assert np.array_equal(whole.hash, sliced.hash)
    flat = [w for t in texts for w in t.split()]
    assert whole.count.tolist() == [len(t.split()) for t in texts]
    by_hash = dict(zip(whole.hash.tolist(), flat, strict=True))
    assert [by_hash[h] for h in whole.hash.tolist()] == flat
    assert len(set(flat)) == len(by_hash)


def test_grams_stay_within_rows():
    words = common.Words([b"a b c", b"a b", b"", b"a b c d"], common.byte_table(common.BLANKS))
    grams, at = words.grams(3)
    assert at.tolist() == [0, 5, 6] and grams[0] == grams[1] != grams[2]


def test_slices_join_to_the_text(monkeypatch):
    monkeypatch.setattr(common, "SLICE_BYTES", 5)
    for text in ["", "abc", "a b c d e f g h", "x" * 30, "x" * 9 + " y"]:
        parts = list(common.text_slices(text))
        assert "".join(parts) == text and all(p.startswith(" ") for p in parts[1:])


def test_blocks_cover_all_rows():
    texts = [b"x" * n for n in (0, 5, 100, 1, 1, 1, 50)]
    ranges = list(common.blocks(texts, 50))
    assert ranges[0][0] == 0 and ranges[-1][1] == len(texts)
    assert all(a[1] == b[0] for a, b in zip(ranges, ranges[1:], strict=False))


def test_bounded_sample(spark):
    df = spark.range(5000).selectExpr("id AS doc_id")
    assert common.bounded_sample(df, "doc_id", 100).count() == 100
    assert common.bounded_sample(df, "doc_id", 10_000).count() == 5000
    assert common.bounded_sample(df.where("doc_id < 0"), "doc_id", 10).count() == 0


@pytest.mark.parametrize("bits", [1, 3, 12])
def test_sample_is_the_smallest_hashes_in_any_layout(spark, bits):
    """Few bits a histogram stand for a table of a huge number of rows."""
    df = spark.range(3000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    want = {r.doc_id for r in df.selectExpr("doc_id", "shiftrightunsigned(xxhash64(doc_id, 'fit'), 1) AS h").orderBy("h").limit(70).collect()}
    for layout in (df, df.repartition(7, "text"), df.coalesce(1)):
        assert {r.doc_id for r in common.bounded_sample(layout, "doc_id", 70, bits).collect()} == want


def test_sample_of_null_and_repeated_keys(spark):
    no_ids = spark.range(4000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "concat('t', id) AS text")
    assert common.bounded_sample(no_ids, "doc_id", 50).count() == 50
    one_id = spark.range(4000).selectExpr("7L AS doc_id", "concat('t', id) AS text")
    assert common.bounded_sample(one_id, "doc_id", 50).select("text").distinct().count() == 50
    third = no_ids.unionByName(spark.range(8000).selectExpr("id AS doc_id", "concat('t', id) AS text"))
    for layout in (third, third.repartition(9, "text")):
        rows = common.bounded_sample(layout, "doc_id", 6000).collect()
        assert len(rows) == 6000 and len(set(rows)) == 6000
    equal_rows = spark.range(4000).selectExpr("7L AS doc_id", "'same' AS text", "map('a', id) AS _h")
    assert common.bounded_sample(equal_rows, "doc_id", 50).count() == 50


def test_fresh_names():
    assert common.fresh_name("_h", ["a"]) == "_h" and common.fresh_name("_h", ["_H", "_h_"]) == "_h__"
