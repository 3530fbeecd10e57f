from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from corate.llm import packing
from corate.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))


def check_places(rows, capacity):
    """Pieces of a sequence follow each other without gaps from 0 on."""
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("capacity", [64, 4096])
def test_pieces_and_places(odd_docs, tokenizer, capacity):
    rows = packing.pack(odd_docs, tokenizer_path("word_bpe_49k.json"), capacity).collect()
    want = []
    for r in odd_docs.collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
        for p in range(0, len(ids), capacity):
            part = ids[p : p + capacity]
            want.append((r.doc_id, p // capacity, p, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert Counter(tuple(r[:5]) for r in rows) == Counter(want)
    check_places(rows, capacity)


def test_empty_table(odd_docs):
    assert packing.pack(odd_docs.where("false"), tokenizer_path("word_bpe_49k.json")).count() == 0


def test_cached_words_equal_the_tokenizer(tokenizer):
    with open(tokenizer_path("word_bpe_49k.json"), encoding="utf-8") as f:
        words = packing.WordTokenizer(f.read())
    rng = random.Random(3)
    alphabet = ["a", "B", "z", "É", "é", "é", "İ", "Σ", "'s", "'", "''", "<|endoftext|>", "1", "23", " ", "  ", "\n", "\t", " ", " ", ".", ",", "|", "中", "\U0001f600", "-", "don't", "\x0b", "\x85"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 14))) for _ in range(3000)]
    for text, got in zip(texts, words.encode(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_fullest_is_the_best_subset_sum():
    rng = random.Random(4)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(rng.randint(0, 6))}
        capacity = rng.randint(0, 60)
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * i for s in sums for i in range(c + 1)}
        chosen = packing.fullest(counts, capacity)
        assert all(m <= counts[n] for n, m in chosen)
        assert sum(n * m for n, m in chosen) == max(s for s in sums if s <= capacity)


def test_patterns_use_every_piece_once():
    rng = random.Random(5)
    histogram = {rng.randint(1, 100): rng.randint(1, 50) for _ in range(60)}
    patterns = packing.minimum_bin_slack(histogram, 100)
    used = Counter()
    for p in patterns:
        assert sum(n * m for n, m in p.lengths) <= 100
        for n, m in p.lengths:
            used[n] += m * p.bins
    assert used == Counter(histogram)
    bins = sum(p.bins for p in patterns)
    total = sum(n * c for n, c in histogram.items())
    assert bins <= max(-(-total // 100) * 1.02 + 1, sum(c for n, c in histogram.items() if n > 50))
