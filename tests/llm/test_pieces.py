from __future__ import annotations

import hashlib
import random

import pytest
import sentencepiece

from corate.llm import pieces
from corate.llm.queries import tokenizer_path

ALPHABET = ["a", "the", "B", "é", "é", " ", "  ", "   ", "\n", "\t", "▁", " ", "中", "\U0001f600", "<0x0A>", "<s>", "</s>", "<unk>", "123", ".", ",", "\x01", "ﬁ", "™", "ing", "tion"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def model():
    with open(tokenizer_path("piece_bpe_32k.model"), "rb") as f:
        return pieces.PieceModel(f.read())


def random_texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choices(ALPHABET, k=rng.randint(0, 20))) for _ in range(n)]


def test_ids_and_decoding_equal_the_library(library, model):
    for text in [*random_texts(1, 4000), "x" * 5000, "ab" * 3000, " ", "\n", " a", "a ", "▁a", "a▁"]:
        ids = model.encode(text)[0].tolist()
        assert ids == library.encode(text), repr(text)
        assert model.decode(ids) == library.decode(ids), repr(text)


def test_spans_cover_the_source(model):
    """Spans follow each other and together are the whole text; each piece's
    span holds what the piece stands for."""
    for text in [t for t in random_texts(2, 2000) if t]:
        ids, starts, ends = model.encode(text)
        data = text.encode()
        assert starts[0] == 0 and ends[-1] == len(data)
        assert starts[1:].tolist() == ends[:-1].tolist()
        first = True
        for i, s, e in zip(ids.tolist(), starts, ends, strict=True):
            surface = model.surface[i]
            if first and surface.startswith(b" "):
                surface = surface[1:]
            first = False
            assert data[s:e].replace("▁".encode(), b" ") == surface or data[s:e] in ("▁".encode(), b""), repr(text)


def normaliser_of(rule):
    """The library's normaliser of a rule, and ours of its compiled map."""
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    from sentencepiece import sentencepiece_model_pb2 as proto

    m = proto.ModelProto()
    m.ParseFromString(library.serialized_model_proto())
    ours = pieces.PieceModel.__new__(pieces.PieceModel)
    ours.charmap = pieces.CharacterMap(m.normalizer_spec.precompiled_charsmap)
    ours.dummy_prefix, ours.trim = m.normalizer_spec.add_dummy_prefix, m.normalizer_spec.remove_extra_whitespaces
    assert not ours.charmap.empty
    return library, ours


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
def test_normalisation_equals_the_library(rule):
    """Longest-prefix normalisation by a compiled map of the library."""
    library, ours = normaliser_of(rule)
    rng = random.Random(6)
    alphabet = ["ﬁ", "①", "㎡", "e\u0301", "\u0301", "Ａ", "Ｂ", "ẛ̣", "ß", "S", "™", "a", "b", " ", "  ", "\u3000", "\t", "\n", "가", "ᄀ", "ᅡ", "Σ"]
    for _ in range(2000):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 10)))
        got, source = ours.normalise(text)
        assert got == library.normalize(text), repr(text)
        assert len(source) == len(got.encode()) + 1
        assert (source[1:] >= source[:-1]).all() and source[-1] <= len(text.encode())


def test_alignment_of_expanding_characters():
    """A ligature becomes two letters; both point at its source bytes."""
    _, ours = normaliser_of("nmt_nfkc")
    ours.dummy_prefix, ours.trim = True, True
    text, source = ours.normalise("  aﬁ  b ")
    assert text == "▁afi▁b"
    assert source.tolist() == [2, 2, 2, 2, 3, 3, 6, 6, 6, 8, 9]


def test_digest_of_odd_rows(odd_docs, library):
    got = pieces.piece_digest(odd_docs, tokenizer_path("piece_bpe_32k.model")).collect()
    want = []
    for r in odd_docs.collect():
        ids = library.encode(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest(), len((r.text or "").encode())))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert pieces.piece_digest(odd_docs.where("false"), tokenizer_path("piece_bpe_32k.model")).count() == 0


def test_encoded_spans_table(docs_df):
    r = pieces.encode_documents(docs_df([(1, "café noir"), (2, None)]), tokenizer_path("piece_bpe_32k.model")).orderBy("doc_id").collect()
    assert r[0].ends[-1] == 10 and len(r[0].ids) == len(r[0].starts) == len(r[0].ends)
    assert r[1].ids == []
