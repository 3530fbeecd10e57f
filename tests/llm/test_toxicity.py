from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from corate.llm import toxicity


def labelled(n, seed=1):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("ra", "lo", "mi", "te") for b in ("no", "sa", "ku", "pe", "vi")]
    insults = ["grimlout", "grimtoad", "foulbeast"]
    rows, labels = [], []
    for i in range(n):
        text = rng.choices(words, k=rng.randint(5, 60))
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rng.randint(1, 4)):
                text.insert(rng.randrange(len(text)), rng.choice(insults))
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def model(spark, docs_df):
    rows, labels = labelled(400)
    return toxicity.fit_toxicity(docs_df(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))


def brute_marginals(model, words):
    """Sum over all label sequences."""
    telling = dict(model.telling(" ".join(w.decode() for w in words))[1])
    total, toxic = 0.0, np.zeros(len(words))
    for states in itertools.product((0, 1), repeat=len(words)):
        score, before = 0.0, 0
        for i, s in enumerate(states):
            score += model.moves[before, s] + (model.bias + telling.get(i, 0.0) if s else 0.0)
            before = s
        p = np.exp(score)
        total += p
        toxic += p * np.array(states)
    return toxic / total


@pytest.mark.parametrize("text", ["grimlout", "rano losa grimlout miku", "grimtoad foulbeast rano rano rano rano grimlout", "rano " * 9 + "foulbeast"])
def test_marginals_equal_all_sequences(model, text):
    want = brute_marginals(model, toxicity.words_of(text))
    n, telling = model.telling(text)
    assert model.marginals(n, telling) == pytest.approx([want[i] for i, _ in telling], rel=1e-6)


def test_marginals_of_a_long_text_stay_finite(model):
    n, telling = model.telling("rano " * 100_000 + "grimlout " * 2_000 + "rano " * 100_000)
    p = model.marginals(n, telling)
    assert n == 202_000
    assert len(p) == 2_000 and np.isfinite(p).all() and min(p) > 0.5


def test_held_out_accuracy_and_offsets(model, docs_df):
    rows, labels = labelled(200, seed=7)
    got = {r.doc_id: r for r in toxicity.score_documents(docs_df(rows), model).collect()}
    assert sum((got[i].score >= 0.5) == bool(t) for i, _, t in labels) >= 196
    text = "Éra rano, GrimLout! losa"
    score, spans = toxicity.score_text(model, text)
    assert score >= 0.5 and [text[s["start"] : s["end"]] for s in spans] == ["GrimLout"]


def test_odd_rows_and_filter(model, odd_docs, docs_df):
    got = toxicity.score_documents(odd_docs, model).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score < 0.5 and r.spans == [] for r in got)
    docs = docs_df([(1, "rano grimlout foulbeast"), (2, "rano losa"), (3, None)])
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]
    assert toxicity.score_documents(docs.where("false"), model).count() == 0


def test_without_labels_nothing_is_toxic(spark, docs_df):
    rows, _ = labelled(20)
    empty = toxicity.fit_toxicity(docs_df(rows), spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert {r.score for r in toxicity.score_documents(docs_df(rows), empty).collect()} == {0.0}
