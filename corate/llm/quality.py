"""Quality rules: fixed counts, then a calibrated n-gram classifier.

The classifier is a logistic regression over hashed word and character
n-grams (relative frequencies, so a text's length doesn't shift its score),
fitted on a bounded sample of labelled rows and calibrated on rows that the
fit did not see. Texts are scored block by block of Arrow batches, against
a fixed threshold.

Defined results: NULL or empty text has no words, fails the base rule and
gets the classifier's intercept; repeated rows get equal results; an empty
table gives an empty result; without labels of both kinds every text that
passes the base rule is kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate.llm.common import BLANKS, SLICE_BYTES, Words, binary_texts, blocks, bounded_sample, byte_table, mix64

# Symbols and thresholds of the base rule.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50
REPEAT_PERCENT = 50

#: A text is kept when its calibrated probability of quality 1 is this high.
KEEP_PROBABILITY = 0.5
#: Labelled rows that the fit takes, and hash buckets of each n-gram kind.
FIT_ROWS = 3_000
BUCKETS = 1 << 11

WORD = byte_table(BLANKS)
_NOT_CODE_POINT = BLANKS + bytes(range(0x80, 0xC0))


def base_counts(texts: list[bytes], words: Words) -> tuple[np.ndarray, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    chars = np.array([len(t.translate(None, _NOT_CODE_POINT)) for t in texts], np.int64)
    symbols = np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in texts], np.int64)
    dup = np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        if b"\n" in t:
            lines = [x for x in t.split(b"\n") if x.strip(BLANKS)]
            dup[i] = len(lines) - len(set(lines))
    grams, at = words.grams(3)
    n = len(words.hash)
    row = np.repeat(np.arange(len(words.count)), words.count)
    keys = mix64(grams ^ (row[at].astype(np.uint64) * np.uint64(0xA0761D6478BD642F)))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n + 2, bool)
    first = at[twice]
    for k in range(3):
        covered[first + k] = True
    repeat = np.bincount(row, weights=covered[:n], minlength=len(texts)).astype(np.int64)
    return words.count.astype(np.int64), chars, symbols, dup, repeat


def hashed_ngrams(texts: list[bytes], words: Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For words, word pairs and character (byte) trigrams, slice by slice:
    the kind, the bucket of each n-gram and the text in which it stands.
    Buckets of the kinds don't overlap."""
    row = np.repeat(np.arange(len(words.count)), words.count)
    pairs, at = words.grams(2)
    yield 0, (words.hash % np.uint64(BUCKETS)).astype(np.int64), row
    yield 1, (pairs % np.uint64(BUCKETS)).astype(np.int64) + BUCKETS, row[at]
    joined = np.frombuffer(b"\x00".join(texts) + b"\x00", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    bits = np.uint32(32 - BUCKETS.bit_length() + 1)
    for first in range(0, len(joined) - 2, SLICE_BYTES):
        data = joined[first : first + SLICE_BYTES + 2].astype(np.uint32)
        code = (data[:-2] * 961 + data[1:-1] * 31 + data[2:]) * np.uint32(2654435761)
        # a separator (or a NUL of the text) ends the trigrams before it
        inside = np.flatnonzero((data[:-2] != 0) & (data[1:-1] != 0) & (data[2:] != 0))
        text = np.searchsorted(ends, first + inside, side="right")
        yield 2, (code[inside] >> bits).astype(np.int64) + 2 * BUCKETS, text


def feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labels and the relative n-gram frequencies as float32 bytes."""
    for batch in batches:
        texts = binary_texts(batch.column(0))
        for a, b in blocks(texts):
            words = Words(texts[a:b], WORD)
            x = np.zeros((b - a, 3 * BUCKETS), np.float32)
            for _, bucket, row in hashed_ngrams(texts[a:b], words):
                np.add.at(x, (row, bucket), 1)
            kinds = x.reshape(b - a, 3, BUCKETS)
            kinds /= np.maximum(kinds.sum(axis=2, keepdims=True), 1)
            yield pa.RecordBatch.from_arrays([batch.column(1).slice(a, b - a).cast(pa.int32()), pa.array([v.tobytes() for v in x], pa.binary())], ["label", "x"])


def logistic_fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float, steps: int = 150) -> tuple[np.ndarray, float]:
    """Weighted logistic regression by Nesterov's accelerated gradient."""
    n, d = x.shape
    w, b = np.zeros(d, x.dtype), 0.0
    vw, vb = w.copy(), b
    weight = (weight / weight.sum()).astype(x.dtype)
    rate = 1.0 / (0.25 * float((weight * (np.einsum("ij,ij->i", x, x) + 1)).sum()) + l2)
    for t in range(steps):
        p = 1 / (1 + np.exp(-(x @ vw + vb)))
        g = (weight * (p - y)).astype(x.dtype)
        nw, nb = vw - rate * (x.T @ g + l2 * vw), vb - rate * float(g.sum())
        k = t / (t + 3)
        vw, vb = nw + k * (nw - w), nb + k * (nb - b)
        w, b = nw, nb
    return w, b


class QualityModel:
    """Weights over all buckets, intercept, and the calibration's slope and
    offset: probability = sigmoid(slope * margin + offset)."""

    def __init__(self, weights: np.ndarray, bias: float, slope: float, offset: float):
        self.weights, self.bias, self.slope, self.offset = weights, bias, slope, offset

    def probability(self, texts: list[bytes], words: Words) -> np.ndarray:
        sums, counts = np.zeros((3, len(texts))), np.zeros((3, len(texts)))
        for kind, bucket, row in hashed_ngrams(texts, words):
            sums[kind] += np.bincount(row, weights=self.weights[bucket], minlength=len(texts))
            counts[kind] += np.bincount(row, minlength=len(texts))
        margin = self.bias + (sums / np.maximum(counts, 1)).sum(axis=0)
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> QualityModel:
    """Fit on at most ``rows`` labelled documents; a fifth of them, chosen
    by hash, calibrates (Platt scaling). Repeated labels of a doc_id count
    once (the largest)."""
    marks = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    sample = bounded_sample(docs.select("doc_id", "text").join(marks, "doc_id"), "doc_id", rows)
    table = sample.select("text", "quality").mapInArrow(feature_rows, "label int, x binary").toArrow()
    y = np.array(table.column("label").to_pylist(), float)
    if not len(y) or y.min() == y.max():
        return QualityModel(np.zeros(3 * BUCKETS), 0.0, 0.0, 30.0)
    x = np.stack([np.frombuffer(v, np.float32) for v in table.column("x").to_pylist()])
    order = np.argsort(x[:, :64] @ np.arange(1, 65), kind="stable")
    x, y = x[order], y[order]
    held = np.arange(len(y)) % 5 == 4
    scale = np.sqrt(np.einsum("ij,ij->j", x, x) / len(x)) + 1e-3
    x /= scale.astype(np.float32)
    balance = np.where(y > 0, 0.5 / max(1, y[~held].sum()), 0.5 / max(1, (1 - y[~held]).sum()))
    w, b = logistic_fit(x[~held], y[~held], balance[~held], l2=0.02)
    margin = x[held] @ w + b
    if y[held].min() == y[held].max():
        slope, offset = 1.0, 0.0
    else:
        center = margin.mean()
        spread = margin.std() + 1e-9
        s, o = logistic_fit(((margin - center) / spread)[:, None], y[held], np.ones(int(held.sum())), l2=1e-4, steps=400)
        slope, offset = float(max(s[0], 0.0) / spread), float(o - max(s[0], 0.0) * center / spread)
    return QualityModel((w / scale).astype(float), b, slope, offset)


FIELDS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, probability double"


def score_batches(model: QualityModel, threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = [f.split()[0] for f in FIELDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = binary_texts(batch.column(1))
            for a, b in blocks(texts):
                words = Words(texts[a:b], WORD)
                n, chars, symbols, dup, repeat = base_counts(texts[a:b], words)
                failed = (n < LEAST_WORDS) | (100 * repeat > REPEAT_PERCENT * n)
                p = model.probability(texts[a:b], words)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a),
                    *(pa.array(v, pa.int64()) for v in (n, chars, symbols, dup, repeat)),
                    pa.array(failed), pa.array(~failed & (p >= threshold)), pa.array(p),
                ], names)
    return run


def quality_rules(docs: DataFrame, model: QualityModel, threshold: float = KEEP_PROBABILITY) -> DataFrame:
    """Base counts, base verdict, final verdict and probability of each row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score_batches(model, threshold), FIELDS)
