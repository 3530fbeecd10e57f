from __future__ import annotations

import random
import re

import pytest

from corate.llm import licenses

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    words = WORD.findall((text or "").translate(LOWER))
    places = [(i, label) for phrase, label in licenses.BASE_PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in places]
    return len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def test_base_equals_brute_force(docs_df, odd_docs):
    rng = random.Random(1)
    parts = ["cc by", "CC-BY", "ccby", "cc", "by", "all rights reserved", "All Rights. Reserved!", "general public license", "General  Public", "License", "x", "é", "9", "\n", "-", " "]
    docs = docs_df([(100 + i, "".join(p + rng.choice([" ", "", "-"]) for p in rng.choices(parts, k=rng.randint(0, 12)))) for i in range(300)]).unionByName(odd_docs)
    got = licenses.license_scan(docs).collect()
    assert sorted((tuple(r[:6]) for r in got), key=repr) == sorted(((r.doc_id, *brute(r.text)) for r in docs.collect()), key=repr)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)


@pytest.mark.parametrize("label", ["mit", "apache-2.0", "bsd", "cc0-1.0", "isc"])
def test_templates_are_found_with_words_missing_and_added(docs_df, label):
    words = licenses.TEMPLATES[label].split()
    rng = random.Random(2)
    noise = [f"n{i}" for i in range(60)]
    exact = " ".join([*noise[:20], *words, *noise[20:]])
    edited = list(words)
    edited.insert(len(words) // 2, "extra")
    scattered = " ".join(w for pair in zip(words, noise * 3, strict=False) for w in pair)
    rng.shuffle(noise)
    docs = docs_df([(1, exact), (2, " ".join(noise)), (3, scattered), (1, exact), *([(4, " ".join(edited))] if len(words) > 10 else [])])
    got = sorted((r.doc_id, label in r.labels.split(",")) for r in licenses.license_scan(docs).collect())
    assert got == [(1, True), (1, True), (2, False), (3, False), *([(4, True)] if len(words) > 10 else [])]


def edits(label):
    """The template with one word added, missing and replaced, anywhere. The
    name stays where without it the text is prose or another template."""
    words = licenses.template_words(licenses.TEMPLATES[label])
    for i in range(len(words)):
        yield [*words[:i], "extra", *words[i:]]
        if not (label in licenses.NAMED_ONLY and words[i] == licenses.NAMES[label]):
            yield [*words[:i], *words[i + 1 :]]
            yield [*words[:i], "other", *words[i + 1 :]]


def test_every_template_with_one_word_edited(docs_df):
    cases = [(label, " ".join(["n1", "n2", *e, "n3"])) for label in licenses.TEMPLATES for e in edits(label)]
    got = {r.doc_id: r for r in licenses.license_scan(docs_df([(i, text) for i, (_, text) in enumerate(cases)])).collect()}
    assert [c for i, c in enumerate(cases) if c[0] not in got[i].labels.split(",")] == []
    assert all(0 < r.score <= 1 for r in got.values())


def test_short_templates(docs_df):
    texts = {
        "Licensed under the Apache License 2.0": "apache-2.0", "x Released under MIT License.": "mit-reference", "released under the MIT": "mit-reference",
        "Released under the BSD License": "", "Released under the License": "", "Licensed under the Eclipse License, Version 2.0": "",
        "licensed under the": "", "the MIT License": "", "released under x x x x x x x the MIT License": "",
        "released under the released under the released under the MIT licence": "mit-reference",
    }
    got = {r.doc_id: r.labels for r in licenses.license_scan(docs_df(list(enumerate(texts)))).collect()}
    assert [got[i] for i in range(len(texts))] == list(texts.values())


def test_spans_are_the_aligned_places(docs_df):
    """Exact notices stand where a plain search finds them; of edited ones the
    span begins and ends with words of the template."""
    rng = random.Random(5)
    rows, want = [], []
    for i, (label, text) in enumerate(licenses.TEMPLATES.items()):
        noise = [f"n{rng.randint(0, 999)}" for _ in range(rng.randint(0, 30))]
        body = licenses.template_words(text)
        rows.append((i, " ".join([*noise, *body, "tail", *noise])))
        want.append((label, len(noise), len(noise) + len(body)))
    got = {r.doc_id: r.spans.split(",") for r in licenses.license_scan(docs_df(rows)).collect()}
    for i, (label, start, end) in enumerate(want):
        assert f"{label}:{start}:{end}" in got[i]
    twice = " ".join(["x", *licenses.template_words(licenses.TEMPLATES["isc"]), *["y"] * 40, *licenses.template_words(licenses.TEMPLATES["isc"])])
    (row,) = licenses.license_scan(docs_df([(1, twice)])).collect()
    n = len(licenses.template_words(licenses.TEMPLATES["isc"]))
    assert row.spans == f"isc:1:{1 + n},isc:{41 + n}:{41 + 2 * n}"


def test_votes_equal_brute_force(spark, docs_df):
    """Diagonals by Spark against all pairs of windows, on whole texts."""
    from pyspark.sql import functions as F

    rng = random.Random(6)
    pool = [w for t in licenses.TEMPLATES.values() for w in licenses.template_words(t)]
    texts = [" ".join(rng.choice(pool) if rng.random() < 0.1 else pool[(at + j) % len(pool)] for j in range(60)) for at in range(0, len(pool), 17)]
    table = licenses.template_windows()
    windows = spark.createDataFrame(table, "label string, position long, hash long, windows long")
    rows, want = [], set()
    for i, text in enumerate(texts):
        words = licenses.Words([licenses.normalise(text.encode())], licenses.WORD)
        hashes, at = [], []
        for k in licenses.window_sizes(licenses.TEMPLATES):
            grams, places = words.grams(k)
            hashes += grams.view("int64").tolist()
            at += places.tolist()
        rows.append((str(i), hashes, at))
        hits = {}
        for label, position, h, _ in table:
            for g, p in zip(hashes, at, strict=True):
                if g == h:
                    hits.setdefault(label, set()).add(p - position)
        for label, diagonals in hits.items():
            order = sorted(diagonals)
            low = order[0]
            for a, b in zip(order, [*order[1:], None], strict=True):
                if b is None or b - a > licenses.NEIGHBOUR:
                    want.add((str(i), label, low, a))
                    low = b
    scanned = spark.createDataFrame(rows, "row_id string, hashes array<long>, at array<long>")
    found = licenses.candidate_spans(scanned, windows).select("row_id", F.explode("candidates").alias("c")).select(
        "row_id", "c.label", F.explode("c.spans").alias("s")).select("row_id", "label", "s.low", "s.high")
    assert {tuple(r) for r in found.collect()} == want and len(want) > 20


def test_empty_table(docs_df):
    assert licenses.license_scan(docs_df([(1, "cc by")]).where("false")).count() == 0
