from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from corate.llm import suffixes


def brute_force(rows, length):
    """Every window of every text in order of (doc_id, text hash order of the
    operator is only needed for repeated ids, which callers avoid)."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            w = data[i : i + length]
            if w in seen:
                gone[i : i + length] = True
            seen.add(w)
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone, [0]))))
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        out.append((doc_id, len(data), int(gone.sum()), len(edges) // 2, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(docs, **options):
    rows = suffixes.repeat_digest(suffixes.remove_repeats(docs, digest=True, **options)).collect()
    return sorted((tuple(r) for r in rows), key=repr)


def planted(seed):
    """Texts of a small alphabet with copies, near copies, shared passages
    and lines, and runs of one letter."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcé", k=rng.randint(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, line = text(30), text(9)
    rows = []
    for i in range(60):
        kind, t = rng.randrange(8), text(rng.randint(0, 60))
        if kind == 0 and rows:
            t = rng.choice(rows)[1]
        elif kind == 1 and rows:
            other = rng.choice(rows)[1] or ""
            at = rng.randint(0, len(other))
            t = other[:at] + rng.choice(["", "x", "é yes "]) + other[at + rng.randint(0, 2) :]
        elif kind == 2:
            t = text(5) + passage[rng.randint(0, 20) :] + text(5)
        elif kind == 3:
            t = "\n".join([text(6), line, text(6), line])
        elif kind == 4:
            t = text(3) + "z" * rng.randint(0, 150) + text(3) + "yx" * rng.randint(0, 80)
        rows.append((i * 3 % 61, t))
    return rows


@pytest.mark.parametrize("seed, options", [
    (1, {"length": 40, "gram": 12}), (2, {"length": 100, "gram": 32}),
    (3, {"length": 40, "gram": 12, "chunk_bytes": 200, "sort_bytes": 100}),
    (4, {"length": 33, "gram": 8, "hot_contexts": 2}), (5, {"length": 21, "gram": 20})])
def test_equals_brute_force(docs_df, seed, options):
    """Also with chunks of one text, sorts of one anchor, and hot anchors."""
    rows = planted(seed)
    want = brute_force(rows, options["length"])
    assert sum(r[2] for r in want) > 0
    assert got(docs_df(rows).repartition(4), **options) == want


def test_long_texts_are_read_in_slices(docs_df, monkeypatch):
    rows = [(i, t * 3) for i, t in planted(9)]
    monkeypatch.setattr(suffixes.slices, "__defaults__", (64,))
    assert got(docs_df(rows).coalesce(1), length=40, gram=12) == brute_force(rows, 40)


def test_odd_rows(docs_df, odd_docs):
    found = {r[0]: r for r in got(odd_docs.where("doc_id <> 7 OR doc_id IS NULL").selectExpr("*", "1 AS k1", "2 AS packed", "3 AS key"))}
    assert found[1] == (1, 0, 0, 0, hashlib.sha256(b"").hexdigest())
    assert found[4][2] < found[4][1] and found[5][2] == found[5][1] and found[5][3] == 1
    assert found[10][1:4] == (300_000, 299_999, 1) and found[None][2] == 0
    text = "a passage of text that is long enough " * 4
    twins = got(docs_df([(7, text), (7, text), (7, "short"), (7, "short"), (None, text), (None, text[:120])]))
    assert sorted(r[1:3] for r in twins if r[0] == 7) == [(5, 0), (5, 0), (len(text), len(text) - 38), (len(text), len(text))]
    assert all(r[1] == r[2] for r in twins if r[0] is None) and len(twins) == 6


def test_empty_table(odd_docs):
    assert got(odd_docs.where("false")) == []


@pytest.mark.parametrize("seed", range(4))
def test_deep_shallow_sort_finds_all_equal_suffixes(seed):
    rng = random.Random(seed)
    data = "".join(rng.choices("ab", [9, 1], k=3000)).encode()
    starts, bucket = np.arange(2950), np.array([rng.randrange(2) for _ in range(2950)])
    want = {}
    for s in range(2950):
        want.setdefault((bucket[s], data[s : s + 26]), []).append(s)
    found = [sorted(x) for x in suffixes.equal_suffixes(data, starts, bucket, 26, 16)]
    assert sorted(found) == sorted(v for v in want.values() if len(v) > 1)


def test_trie_gives_strings_in_order():
    rng = random.Random(8)
    data = bytes(rng.choices(b"abc", k=500))
    trie = suffixes.BlindTrie(data, 9)
    for s in range(480):
        trie.add(s, s)
    order = [data[x[0] : x[0] + 9] for x in trie.leaves()]
    assert order == sorted({data[s : s + 9] for s in range(480)})


def test_sliding_minimum():
    values = np.array([5, 3, 8, 1, 9, 2, 7], np.uint64)
    for w in range(1, 8):
        assert suffixes.sliding_min(values, w).tolist() == [min(values[i : i + w]) for i in range(8 - w)]
