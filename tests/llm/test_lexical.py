from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from corate.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id bigint, text string"


def words(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return TERM.findall(lowered)


def brute_force(docs, items, k):
    """Every item against every document, by the formula."""
    counted = [(d, Counter(words(t))) for d, t in docs if words(t)]
    n_docs, total = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in counted:
            m = 75 + (25 * c.total() * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                    for t in words(text) if c[t])
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(item, r + 1, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def got(frame):
    return sorted((tuple(r) for r in frame.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.mark.parametrize("item_bytes", [60, 1 << 20])
def test_equals_brute_force(spark, docs_df, monkeypatch, item_bytes):
    """One block of items and many; several documents a step and one."""
    if item_bytes == 60:
        monkeypatch.setattr(lexical, "SCORE_CELLS", 1)
    rng = random.Random(3)
    word = lambda: rng.choice(["Alpha", "beta", "GAMMA7", "δέλτα", "don't", "x", "É", "é", "zeta_eta"])
    docs = [(i, " ".join(word() for _ in range(rng.randint(0, 30)))) for i in range(120)] + [(500, None), (None, "alpha x x"), (7, "alpha x x")]
    items = [(i, " ".join(word() for _ in range(rng.randint(0, 6)))) for i in range(15)] + [(99, None), (3, "beta beta beta"), (100, "nowhere")]
    found = lexical.search(docs_df(docs).repartition(5), spark.createDataFrame(items, ITEMS), k=4, item_bytes=item_bytes)
    assert got(found) == brute_force(docs, items, 4)


def test_odd_rows_extra_columns_and_empty_tables(spark, odd_docs):
    items = spark.createDataFrame([(1, "one word5x5"), (None, "CAFÉ café")], ITEMS)
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    want = brute_force(rows, [(1, "one word5x5"), (None, "CAFÉ café")], 20)
    odd = odd_docs.selectExpr("*", "'x' AS item_id", "1 AS score", "2 AS item", "3 AS n", "4 AS `rank`")
    assert got(lexical.search(odd, items.selectExpr("*", "5 AS doc_id", "6 AS size"))) == want
    assert lexical.search(odd_docs.where("false"), items).count() == 0
    empty = lexical.search(odd_docs, items.where("false"))
    assert empty.count() == 0 and empty.columns == ["item_id", "rank", "doc_id", "score"]


def test_slices_of_long_texts_count_alike(monkeypatch):
    text = "Ab cd3 é-f " * 50
    whole = list(lexical.terms_of(text))
    monkeypatch.setattr(lexical, "SLICE_BYTES", 7)
    assert list(lexical.terms_of(text)) == whole and len(whole) == 200
