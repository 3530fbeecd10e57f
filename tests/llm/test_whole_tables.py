"""Exact columns of registered queries over whole tables, against plain
Python or the public library that states the result."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pytest
from test_packing import check_places
from test_quality import brute as quality_counts

from corate.llm import queries

SF = "/root/testdata/sf0.01"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
# fixed values of the contracts
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in rows}


def by_doc(rows, texts):
    found = {r.doc_id: r for r in rows}
    assert len(rows) == len(found) and found.keys() == texts.keys()
    return found


def test_quality_counts(spark, texts):
    rows = by_doc(queries.op3_quality_rules(spark, SF).collect(), texts)
    for doc_id, text in texts.items():
        r, want = rows[doc_id], quality_counts(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def test_pieces_of_all_documents(spark, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path("word_bpe_49k.json"))
    rows = queries.op6_best_fit_packing(spark, SF).collect()
    want, total = set(), 0
    for doc_id, text in texts.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
        total += len(ids)
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            want.add((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert len(got) == len(want) and set(got) == want
    assert check_places(rows, 4096) <= -(-total // 4096) + 1


def test_ids_of_all_documents(spark, texts):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_path("piece_bpe_32k.model"))
    rows = by_doc(queries.op7_sentencepiece(spark, SF).collect(), texts)
    for doc_id, text in texts.items():
        ids = model.encode(text)
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(model.decode(ids).encode()).hexdigest())
        assert (rows[doc_id].n_tokens, rows[doc_id].ids_sha256, rows[doc_id].decoded_sha256) == want


def test_rules_of_all_urls(spark):
    rows = queries.op8_url_filters(spark, SF).collect()
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        match = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", pages[r.page_id] or "")
        host, path = (match[1].translate(LOWER), match[2]) if match else ("", "")
        fits = [(h, p, v) for h, p, v in RULES if (host == h or host.endswith(f".{h}")) and path.startswith(p)]
        best = max(fits, key=lambda rule: len(rule[0] + rule[1]), default=None)
        assert (r.host, r.path, r.rule) == (host, path, best and best[0] + best[1])
        assert r.verdict == best[2] if best else r.verdict in ("allow", "block")


def test_base_phrases_of_all_documents(spark, texts):
    rows = by_doc(queries.op10_license_scan(spark, SF).collect(), texts)
    for doc_id, text in texts.items():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(LOWER))
        places = []
        for phrase, label in PHRASES.items():
            want = phrase.split()
            starts = [i for i, w in enumerate(words) if w == want[0]]
            places += [(i, label) for i in starts if words[i : i + len(want)] == want]
        r, at, base = rows[doc_id], [i for i, _ in places], {label for _, label in places}
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words), len(at), min(at, default=None), max(at, default=None))
        assert r.base_labels == ",".join(sorted(base))
        assert base <= set(r.labels.split(",")) and 0 <= r.score <= 1
