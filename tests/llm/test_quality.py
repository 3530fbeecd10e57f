from __future__ import annotations

import random
import re
from collections import Counter

from corate.llm import quality

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if n[w] > 1:
            covered |= {i, i + 1, i + 2}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def make_rows(n, seed=1):
    rng = random.Random(seed)
    good = ["the", "river", "runs", "along", "green", "hills", "and", "people", "walk"]
    bad = ["BUY!!", "$$$", "###", "CLICK!!", "NOW%%", "&&&"]
    rows, labels = [], []
    for i in range(n):
        q = i % 2
        rows.append((i, " ".join(rng.choices(good if q else bad, k=70)) + f" end{i}"))
        labels.append((i, q, 0))
    return rows, labels


def test_base_counts_equal_brute_force(odd_docs, docs_df, spark):
    rng = random.Random(2)
    texts = ["".join(rng.choices(["a", "b", "cc", "é", " ", "\n", "\t", "#", "\x0b", "\x1c", " "], k=rng.randint(0, 80))) for _ in range(400)]
    docs = docs_df([(i, t) for i, t in enumerate(texts)]).unionByName(odd_docs)
    empty = spark.createDataFrame([], "doc_id bigint, quality int")
    got = quality.quality_rules(docs, quality.fit_quality(docs, empty)).collect()
    want = sorted(((r.doc_id, *brute(r.text)) for r in docs.collect()), key=repr)
    assert sorted((tuple(r[:6]) for r in got), key=repr) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_classifier_separates_held_out_rows(docs_df, spark):
    rows, labels = make_rows(400)
    model = quality.fit_quality(docs_df(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    fresh, marks = make_rows(60, seed=9)
    got = {r.doc_id: r for r in quality.quality_rules(docs_df([(i, " ".join(dict.fromkeys(t.split()))) for i, t in fresh]), model).collect()}
    assert all((got[i].probability >= 0.5) == bool(q) for i, q, _ in marks)


def test_empty_table(docs_df, spark):
    rows, labels = make_rows(20)
    model = quality.fit_quality(docs_df(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    assert quality.quality_rules(docs_df(rows).where("false"), model).count() == 0
