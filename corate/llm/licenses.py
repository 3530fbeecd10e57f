"""License scans: base phrases, then diagonal voting against templates.

A task hashes every rolling window of K words of its texts. Spark joins the
hashes to the templates' window positions. A hit at document word i and
template word j lies on diagonal i - j; hits are counted per (row, template,
diagonal), and neighbouring diagonals are merged (words may be missing or
added). One hit makes a candidate. It is verified word by word: the words of
the template that stand in order in the document there must be enough of it,
and always are if only one is missing, added or replaced. The verified
template's label is the method's label. A template of fewer than 2 K words
votes with its first and last half, of which one edit leaves one.

Windows whose hash is in no template cannot join; a bitmap of the template
hashes drops them before the shuffle, as a runtime filter does. It only
drops rows without a partner.

Defined results: NULL or empty text has no words, no places, NULL first and
last word, empty label strings and score 0; equal rows give equal results;
repeated doc_ids stay apart (a row number is carried through the join).
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corate.config import materialize
from corate.llm.common import Words, binary_texts, blocks

# Base phrases and their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Words of one window, tolerance between merged diagonals, and the share of
#: a template's windows that the words aligned in one piece would hit.
K = 4
NEIGHBOUR = 3
VERIFY_SHARE = 0.6
#: What a document word between two aligned ones costs.
EXTRA_WORD = 0.5

# Notices as their licenses prescribe them.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-notice": "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "mit-reference": "Released under the MIT License",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "lgpl-notice": "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "unlicense": "This is free and unencumbered software released into the public domain",
}

# The word by which a template names its license. Without it
# the text is plain prose or another template's, or, if one of the other names
# stands there, another license's.
NAMES = {"apache-2.0": "apache", "mit-reference": "mit", "lgpl-notice": "lesser", "cc-by-sa-4.0": "sharealike", "mpl-2.0": "mozilla"}
NAMED_ONLY = {"mit-reference", "lgpl-notice", "cc-by-sa-4.0"}
OTHER_NAMES = ("apache", "mit", "bsd", "gnu", "gpl", "lgpl", "agpl", "mozilla", "mpl", "eclipse", "educational", "academic", "artistic", "microsoft", "netscape", "php", "zope")

#: Word bytes after lower-casing: digits, a-z and all bytes of other letters.
_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_TO_SPACE = bytes(0x20 if c in _SEPARATORS else c for c in range(256))
WORD = np.array([c not in _SEPARATORS for c in range(256)])
BITMAP_BITS = 20


def normalise(text: bytes) -> bytes:
    """Lower-case A-Z and put a blank for every byte that no word holds."""
    return text.lower().translate(_TO_SPACE)


def template_words(text: str) -> list[str]:
    return normalise(text.encode()).decode().split()


def template_windows(templates: dict[str, str] = TEMPLATES, k: int = K) -> list[tuple[str, int, int, int]]:
    """(label, position, hash, windows of the template, 0 if they don't cover
    it); a template shorter than k words is rejected."""
    rows = []
    for label, text in templates.items():
        words = Words([normalise(text.encode())], WORD)
        n = len(words.hash)
        if n < k:
            raise ValueError(f"template {label} has fewer than {k} words")
        grams, at = words.grams(k if n >= 2 * k else n // 2)
        if n >= 2 * k:
            rows += [(label, int(i), int(h), len(grams)) for i, h in zip(at, grams.view(np.int64), strict=True)]
        else:
            rows += [(label, int(at[i]), int(grams[i : i + 1].view(np.int64)[0]), 0) for i in sorted({0, len(grams) - 1})]
    return rows


def window_sizes(templates: dict[str, str], k: int = K) -> list[int]:
    """Words of the windows that the templates vote with."""
    sizes = [len(template_words(t)) for t in templates.values()]
    return sorted({k if n >= 2 * k else n // 2 for n in sizes})


def vocabulary(templates: dict[str, str]) -> dict[int, str]:
    """The words that verification looks at, by their hashes."""
    words = sorted({w for t in templates.values() for w in template_words(t)} | set(OTHER_NAMES))
    return dict(zip(Words([" ".join(words).encode()], WORD).hash.view(np.int64).tolist(), words, strict=True))


class Aligner:
    """Word-level comparison of one template with a piece of a document."""

    def __init__(self, label: str, text: str, k: int = K, share: float = VERIFY_SHARE):
        self.words = template_words(text)
        self.places: dict[str, list[int]] = {}
        for j, w in enumerate(self.words):
            self.places.setdefault(w, []).insert(0, j)
        n = len(self.words)
        self.need = min(n - 1, math.ceil(share * (n - k + 1) + k - 1 - 1e-9))
        self.name, self.named_only = NAMES.get(label), label in NAMED_ONLY
        self.others = set(OTHER_NAMES) - set(self.words)

    def share(self, at: list[int], words: list[str]) -> float:
        return self.best_span(at, words)[0]

    def best_span(self, at: list[int], words: list[str]) -> tuple[float, int, int]:
        """The largest share of template words that stand in order in a dense
        piece of the document, given by its known words' places, and the piece
        (first word and the one after its last); share 0 if it is not enough.
        Chains of aligned words are extended word by word."""
        best, span = 0.0, (0, 0)
        # by last template word: value plus cost up to here, words, first place
        chains: list[tuple[float, int, int]] = [(-math.inf, 0, 0)] * len(self.words)
        for i, (p, w) in enumerate(zip(at, words, strict=True)):
            for j in self.places.get(w, ()):
                value, n, first = chains[j - 1] if j else (-math.inf, 0, 0)
                value -= EXTRA_WORD * p
                value, n, first = (value + 1, n + 1, first) if value > 0 else (1.0, 1, p)
                entry = (value + EXTRA_WORD * (p + 1), n, first)
                for t in range(j, len(chains)):
                    if chains[t] >= entry:
                        break
                    chains[t] = entry
                if n >= self.need and n > best * len(self.words) and 2 * n >= p - first + 1 and self.right_name(words[bisect.bisect_left(at, first) : i + 1]):
                    best, span = n / len(self.words), (first, p + 1)
        return (best, *span)

    def right_name(self, words: list[str]) -> bool:
        if self.name is None or self.name in words:
            return True
        return not self.named_only and self.others.isdisjoint(words)


def bitmap(hashes: list[int]) -> np.ndarray:
    bits = np.zeros(1 << BITMAP_BITS, bool)
    bits[np.array(hashes, np.int64).view(np.uint64) >> np.uint64(64 - BITMAP_BITS)] = True
    return bits


def phrase_places(text: bytes) -> list[tuple[int, str]]:
    """(word index, label) of every place of a base phrase in a normalised text."""
    if not any(p.replace(" ", "").encode() in text.replace(b" ", b"") for p in BASE_PHRASES):
        return []
    joined = b" " + b" ".join(text.split()) + b" "
    places = []
    for phrase, label in BASE_PHRASES.items():
        p, at = b" " + phrase.encode() + b" ", -1
        while (at := joined.find(p, at + 1)) >= 0:
            places.append((joined.count(b" ", 0, at), label))
    return places


SCANNED = "row_id string, doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, hashes array<long>, at array<long>, words array<long>, words_at array<long>"


def scan(bits: np.ndarray, sizes: list[int], known: np.ndarray, reach: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Base results of every row, with the windows that may match a template
    and the ``known`` words within ``reach`` words of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = [normalise(t) for t in binary_texts(batch.column(1))]
            for a, b in blocks(texts):
                words = Words(texts[a:b], WORD)
                hits = []
                for k in sizes:
                    grams, at = words.grams(k)
                    hit = np.flatnonzero(bits[grams >> np.uint64(64 - BITMAP_BITS)])
                    hits.append((grams[hit].view(np.int64), at[hit]))
                grams, at = (np.concatenate(x) for x in zip(*hits, strict=True))
                order = np.argsort(at, kind="stable")
                grams, at = grams[order], at[order]
                row = np.searchsorted(words.first, at, side="right") - 1
                bounds = np.searchsorted(row, np.arange(b - a + 1))
                near = np.zeros(len(words.hash) + 1, np.int64)
                np.add.at(near, np.maximum(at - reach, words.first[row]), 1)
                np.add.at(near, np.minimum(at + reach, words.first[row + 1]), -1)
                place = np.flatnonzero(np.cumsum(near)[:-1] > 0)
                place = place[np.isin(words.hash[place].view(np.int64), known)]
                word_bounds = np.searchsorted(place, words.first)
                base = [phrase_places(t) for t in texts[a:b]]
                yield pa.RecordBatch.from_arrays([
                    pa.array([f"{task}-{number + i}" for i in range(b - a)]),
                    batch.column(0).slice(a, b - a),
                    pa.array(words.count, pa.int64()),
                    pa.array([len(x) for x in base], pa.int64()),
                    pa.array([min((p for p, _ in x), default=None) for x in base], pa.int64()),
                    pa.array([max((p for p, _ in x), default=None) for x in base], pa.int64()),
                    pa.array([sorted({y for _, y in x}) for x in base], pa.list_(pa.string())),
                    pa.array([grams[s:e] for s, e in zip(bounds, bounds[1:], strict=False)], pa.list_(pa.int64())),
                    pa.array([at[s:e] - words.first[i] for i, (s, e) in enumerate(zip(bounds, bounds[1:], strict=False))], pa.list_(pa.int64())),
                    pa.array([words.hash[place[s:e]].view(np.int64) for s, e in zip(word_bounds, word_bounds[1:], strict=False)], pa.list_(pa.int64())),
                    pa.array([place[s:e] - words.first[i] for i, (s, e) in enumerate(zip(word_bounds, word_bounds[1:], strict=False))], pa.list_(pa.int64())),
                ], [f.split()[0] for f in SCANNED.split(", ")])
                number += b - a
    return run


def candidate_spans(scanned: DataFrame, templates: DataFrame, neighbour: int = NEIGHBOUR) -> DataFrame:
    """Candidates of each row: row_id and an array of (label, whole, spans),
    spans being the least and largest merged diagonal and the one on which
    all windows of the template were hit, if any; whole says whether one is.

    ``scanned`` holds row_id and the arrays hashes and at; ``templates`` has
    label, position, hash and windows. Votes are counted per diagonal first,
    so the windows below run over one row per (row, template, diagonal)."""
    hits = scanned.select("row_id", F.explode(F.arrays_zip("hashes", "at")).alias("h")).select("row_id", F.col("h.hashes").alias("hash"), F.col("h.at").alias("at"))
    votes = (hits.join(templates, "hash")
             .groupBy("row_id", "label", "windows", (F.col("at") - F.col("position")).alias("diagonal"))
             .agg(F.count("*").alias("hits")))
    by = Window.partitionBy("row_id", "label").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(by)
    runs = votes.withColumn("run", F.sum(F.when(gap <= neighbour, 0).otherwise(1)).over(by))
    # the diagonal on which all windows were hit, where there is one
    whole = F.min(F.when(F.col("hits") == F.col("windows"), F.col("diagonal"))).alias("whole")
    merged = runs.groupBy("row_id", "label", "run").agg(whole, F.min("diagonal").alias("low"), F.max("diagonal").alias("high"))
    labels = merged.groupBy("row_id", "label").agg(F.max(F.col("whole").isNotNull()).alias("whole"), F.collect_list(F.struct("low", "high", "whole")).alias("spans"))
    return labels.groupBy("row_id").agg(F.collect_list(F.struct("label", "whole", "spans")).alias("candidates"))


VERIFIED = "row_id string, found array<string>, best double, spans array<struct<label:string,start:long,end:long>>"


def verify(templates: dict[str, str], k: int = K, slack: int = NEIGHBOUR) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Labels of the candidates (row_id, words, words_at, candidates) whose
    words align with their template, the best share, and the aligned places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = vocabulary(templates)
        aligners = {label: Aligner(label, text, k) for label, text in templates.items()}
        for batch in batches:
            found, best, places = [], [], []
            for hashes, at, candidates in zip(*(batch.column(i).to_pylist() for i in range(1, 4)), strict=True):
                words, shares, spans = [names[h] for h in hashes], {}, set()
                for c in candidates:
                    label = c["label"]
                    aligner, n = aligners[label], len(aligners[label].words)
                    if c["whole"]:
                        shares[label] = 1.0
                    for span in c["spans"]:
                        a, b = bisect.bisect_left(at, span["low"] - n), bisect.bisect_left(at, span["high"] + 2 * n + slack)
                        share, start, end = aligner.best_span(at[a:b], words[a:b])
                        if share == 0 and span["whole"] is not None:
                            share, start, end = 1.0, span["whole"], span["whole"] + n
                        if share > 0:
                            shares[label] = max(shares.get(label, 0.0), share)
                            spans.add((start, label, end))
                found.append(sorted(label for label, share in shares.items() if share > 0))
                best.append(max(shares.values(), default=0.0))
                places.append([{"label": label, "start": start, "end": end} for start, label, end in sorted(spans)])
            kind = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string())), pa.array(best, pa.float64()), pa.array(places, kind)], ["row_id", "found", "best", "spans"])
    return run


def license_scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, k: int = K) -> DataFrame:
    """Per row: base columns, base_labels, labels, score (the best share of a
    verified template's words, 1 for a base phrase, else 0) and spans, the
    verified places as label:start:end in words (end exclusive), by start."""
    spark: SparkSession = docs.sparkSession
    rows = template_windows(templates, k)
    table = spark.createDataFrame(rows, "label string, position long, hash long, windows long")
    rows_in = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = np.array(list(vocabulary(templates)), np.int64)
    reach = 2 * max(len(template_words(t)) for t in templates.values()) + NEIGHBOUR
    # two branches read it; of texts it holds the known words near hits
    scanned = materialize(rows_in.mapInArrow(scan(bitmap([r[2] for r in rows]), window_sizes(templates, k), known, reach), SCANNED), "license-scan")
    hit = scanned.where(F.size("hashes") > 0)
    labels = hit.select("row_id", "words", "words_at").join(candidate_spans(hit, table), "row_id").mapInArrow(verify(templates, k), VERIFIED)
    joined = scanned.select("row_id", "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").join(labels, "row_id", "left")
    every = F.array_sort(F.array_union("base_labels", F.coalesce("found", F.array().cast("array<string>"))))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        F.coalesce(F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["label"], s["start"].cast("string"), s["end"].cast("string"))), ","), F.lit("")).alias("spans"),
    )
