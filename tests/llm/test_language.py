from __future__ import annotations

import random

import pytest

from corate.llm import language

TEXTS = {"en": "the river and the hill were there when they went along with them", "de": "der fluss und die berge waren schon da als wir kamen und schliefen", "fr": "les rivières et les collines étaient là quand nous sommes arrivés"}


@pytest.fixture(scope="module")
def model():
    return language.LanguageModel(TEXTS)


def test_phrases_equal_substring_search(model):
    table = language.symbols()
    rng = random.Random(1)
    sources = {k: bytes(table[b] for b in v.encode()) for k, v in TEXTS.items()}
    words = " ".join(TEXTS.values()).split()
    for _ in range(60):
        text = " ".join(rng.choices(words, k=rng.randint(1, 30))).encode()
        coded = bytes(table[b] for b in text)
        got = model.phrases([text])[0]
        for j, k in enumerate(model.languages):
            # classes that no language has seen can't stand in these texts
            want = greedy(coded, sources[k])
            assert got[j] == want


def greedy(coded: bytes, source: bytes) -> int:
    """As the automaton counts: a phrase starts at the first byte, and anew
    whenever the match can't go on; an unknown byte is a phrase by itself."""
    n, match = 1, b""
    for i in range(len(coded)):
        c = coded[i : i + 1]
        if match + c in source:
            match += c
        else:
            n += 1
            match = c if c in source else b""
    return n


def test_lanes_add_up(model):
    long = (TEXTS["de"] + " ") * 500
    short = TEXTS["en"]
    together = model.phrases([long.encode(), short.encode(), b""])
    assert together[0].tolist() == model.phrases([long.encode()])[0].tolist()
    assert together[1].tolist() == model.phrases([short.encode()])[0].tolist()
    assert together[2].tolist() == [0, 0, 0]


def test_predictions(model, docs_df):
    docs = docs_df([(1, "they went along the hill"), (2, "WIR KAMEN UND schliefen"), (3, "quand les collines étaient"), (4, None), (5, ""), (6, "123 !!"), (7, "the " * 50_000)])
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, model).collect()}
    assert [got[i][0] for i in range(1, 8)] == ["en", "de", "fr", "und", "und", "und", "en"]
    assert all(0 <= s <= 1 for _, s in got.values()) and got[4][1] == 0


def test_fit_from_labelled_rows(docs_df, odd_docs):
    rows = [(i, TEXTS[k] + f" {i}", k) for i, k in enumerate(list(TEXTS) * 10)] + [(99, "nothing", None), (98, None, "en")]
    model = language.fit_languages(docs_df(rows))
    assert model.languages == ["de", "en", "fr"]
    got = {r.doc_id: r.lang_pred for r in language.identify(docs_df(rows), model).collect()}
    assert all(got[i] == k for i, _, k in rows[:30])
    assert language.identify(odd_docs, model).count() == odd_docs.count()


def test_long_rows_are_learned_from(docs_df):
    """A language of long rows only has a model, and no row fills it alone."""
    def long(k, i):
        return f"{k}{i} " + (TEXTS[k] + " ") * 1500

    rows = [(i, long(k, i), k) for i, k in enumerate(["de", "fr"] * 3)] + [(9, TEXTS["en"], "en"), (None, "1 " * 200_000 + "\u00e9t\u00e9", "xx")]
    model = language.fit_languages(docs_df(rows))
    assert model.languages == ["de", "en", "fr", "xx"]
    docs = docs_df([(1, TEXTS["de"]), (2, TEXTS["fr"]), (3, TEXTS["en"])])
    assert [r.lang_pred for r in language.identify(docs, model).orderBy("doc_id").collect()] == ["de", "fr", "en"]


def test_many_rows_share_the_fit_wherever_they_are_cut(docs_df):
    """Rows of 30 KB: each of 60 gives a slice, whatever the partitions."""
    rows = [(i, " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}q{chr(97 + j % 26)}" for j in range(6000)), "aa") for i in range(60)]
    docs = docs_df(rows)
    model = language.fit_languages(docs)
    again = language.fit_languages(docs.repartition(7))
    assert model.table.tolist() == again.table.tolist()
    # the words of a row are known where it gave a slice
    parts = [f"{chr(97 + i % 26)}{chr(97 + i // 26)}q".encode() for i in range(60)]
    known = sum(int(model.phrases([p])[0][0]) == 1 for p in parts)
    assert known >= 55


def test_nothing_learned(docs_df):
    model = language.fit_languages(docs_df([(1, "text", None)]))
    assert [r.lang_pred for r in language.identify(docs_df([(1, "text")]), model).collect()] == ["und"]
    assert language.identify(docs_df([(1, "text")]).where("false"), model).count() == 0


def test_models_of_many_languages_stay_within_their_bytes():
    texts = {f"l{i:03d}": "".join(chr(97 + (i * 7 + j * j) % 26) for j in range(3000)) for i in range(40)}
    model = language.LanguageModel(texts, model_bytes=1 << 20)
    assert len(model.languages) == 40 and model.table.nbytes <= 1 << 20 and model.table.dtype.itemsize == 4
    assert model.predict([texts["l007"][:60]])[0] == ["l007"]
    whole = language.LanguageModel({"a": "abc" * 50})
    assert whole.table.nbytes < language.MODEL_BYTES and language.share_of(1, 155, language.MODEL_BYTES) == language.FIT_BYTES
    with pytest.raises(ValueError):
        language.LanguageModel(texts, model_bytes=1 << 33)
