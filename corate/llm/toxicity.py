"""Toxicity by a linear-chain conditional random field.

A two-state chain (ordinary, toxic) runs over the words of a text. Its
features are whole words and word prefixes that labelled documents show to
be telling; words without one share a single neutral emission. Training
tokens are labelled from document labels: in a toxic document a word with a
strongly telling feature is toxic, all others are ordinary.

Scoring is exact forward-backward over the whole text. A run of n neutral
words is the n-th power of one 2x2 matrix, known in closed form, so only
words with features are visited. The marginals give toxic spans, and their
largest value and sum, calibrated on labelled documents, the score.

Defined results: NULL or empty text has no spans and the score of a text
without toxic words; equal rows give equal results; without labels of both
kinds the score is 0; rows with NULL doc_id are scored but never learned
from; a word of any length is one word.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate.llm.common import bounded_sample, text_slices
from corate.llm.quality import logistic_fit

#: Labelled documents that the fit takes, features it keeps, and words of a
#: training window.
FIT_ROWS = 6_000
FEATURES = 2_000
WINDOW = 24
WINDOWS = 40_000
#: Log-odds from which a feature is kept, and from which it labels a token.
KEEP_LOG_ODDS = 1.8
LABEL_LOG_ODDS = 2.8
#: Bytes of the word prefixes that may be features.
PREFIXES = (4, 5, 6)
SPAN_MARGINAL = 0.5

WORD = re.compile("[A-Za-z\u0080-\U0010ffff]+")
_TO_SPACE = bytes(c if c >= 0x80 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def words_of(text: str) -> list[bytes]:
    """Lower-cased words as UTF-8 bytes; the i-th is the i-th WORD match."""
    return text.lower().encode().translate(_TO_SPACE).split()


def features_of(word: bytes) -> list[bytes]:
    """The whole word, then its prefixes (marked by a trailing ``*``)."""
    return [word, *(word[:n] + b"*" for n in PREFIXES if len(word) >= n)]


def document_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: in how many toxic and other documents each feature stands."""
    counts = (Counter(), Counter())
    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts[toxic].update({f for w in set(words_of(text or "")) for f in features_of(w)})
    keys = list(counts[1])  # a feature of no toxic document can't be telling
    for first in range(0, len(keys), 50_000):
        part = keys[first : first + 50_000]
        yield pa.RecordBatch.from_arrays([
            pa.array(part, pa.binary()), pa.array([counts[1][k] for k in part], pa.int64()), pa.array([counts[0][k] for k in part], pa.int64()),
        ], ["feature", "toxic", "other"])


def rest_features(wanted: set[bytes]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per task: in how many ordinary documents each wanted feature stands."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update({f for w in set(words_of(text or "")) for f in features_of(w) if f in wanted})
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["feature", "other"])
    return run


class ToxicityModel:
    """The chain's parameters and the calibration of the document score."""

    def __init__(self, features: list[bytes], weights: np.ndarray, bias: float, moves: np.ndarray, calibration: tuple[np.ndarray, float] | None = None):
        self.weight = dict(zip(features, weights.tolist(), strict=True))
        self.stems = {f.rstrip(b"*")[:3] for f in features}
        self.moves, self.bias = moves, bias
        self.calibration = calibration
        # neutral step: transition, then the neutral emission
        step = np.exp(moves) * np.exp([0.0, bias])[None, :]
        values, vectors = np.linalg.eig(step)
        order = np.argsort(-values.real)
        self._ratio = float(values.real[order[1]] / values.real[order[0]])
        v = vectors.real[:, order]
        inverse = np.linalg.inv(v)
        self._main, self._rest = np.outer(v[:, 0], inverse[0]), np.outer(v[:, 1], inverse[1])
        self._transition = np.exp(moves)

    def run_of(self, n: int) -> np.ndarray:
        """The n-th power of the neutral step, up to a positive factor."""
        return self._main + self._ratio**n * self._rest

    def telling(self, text: str) -> tuple[int, list[tuple[int, float]]]:
        """Number of words, and (index, emission) of those with features."""
        stems, weight = self.stems, self.weight
        out, n = [], 0
        for part in text_slices(text):
            words = words_of(part)
            for i in [i for i, w in enumerate(words) if w[:3] in stems]:
                found = [weight[f] for f in features_of(words[i]) if f in weight]
                if found:
                    out.append((n + i, sum(found)))
            n += len(words)
        return n, out

    def marginals(self, n_words: int, telling: list[tuple[int, float]]) -> list[float]:
        """Probability of the toxic state at each telling word: exact
        forward-backward, with neutral runs as matrix powers. All chains
        start in the ordinary state."""
        forward, at, alphas = np.array([1.0, 0.0]), -1, []
        for i, e in telling:
            f = forward @ self.run_of(i - at - 1) @ self._transition
            f = f * np.exp([0.0, min(self.bias + e, 60.0)])
            forward, at = f / f.sum(), i
            alphas.append(forward)
        backward, out, after = np.ones(2), [], n_words
        for (i, e), a in zip(reversed(telling), reversed(alphas), strict=True):
            b = self.run_of(after - i - 1) @ backward
            p = a * b
            out.append(float(np.clip(p[1] / p.sum(), 0.0, 1.0)))
            backward = self._transition @ (np.exp([0.0, min(self.bias + e, 60.0)]) * b)
            backward, after = backward / backward.sum(), i
        return out[::-1]

    def summary(self, n_words: int, marginals: list[float]) -> tuple[float, float, float]:
        """What the document score is made of: the evidence -log(1 - p) of
        the surest word, that of all (together: that some word is toxic),
        and that of all for the length."""
        evidence = [-np.log1p(-min(p, 0.9999)) for p in marginals]
        total = sum(evidence)
        return max(evidence, default=0.0), np.log1p(total), total / np.sqrt(n_words + 20.0)

    def score(self, n_words: int, marginals: list[float]) -> float:
        if self.calibration is None:
            return 0.0
        w, b = self.calibration
        return float(1 / (1 + np.exp(-np.clip(np.dot(w, self.summary(n_words, marginals)) + b, -30, 30))))


def training_windows(features: list[bytes], log_odds: list[float]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Windows of labelled tokens that hold a telling word: per token its
    features' numbers and its label, flattened."""
    number = {f: i for i, f in enumerate(features)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, toxic, doc_id in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                words = words_of(text or "")
                known = [(i, [number[f] for f in features_of(w) if f in number]) for i, w in enumerate(words)]
                for start, own in groupby((x for x in known if x[1]), key=lambda x: x[0] // WINDOW):
                    inside = [(i - start * WINDOW, k) for i, k in own]
                    n = min(WINDOW, len(words) - start * WINDOW)
                    rows.append((doc_id, start, n, [i for i, k in inside for _ in k], [x for _, k in inside for x in k],
                                 [i for i, k in inside if toxic and max(log_odds[x] for x in k) >= LABEL_LOG_ODDS]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 6, kinds, strict=True)], ["doc_id", "start", "n", "at", "feature", "toxic_at"])
    return run


def fit_chain(windows: list, n_features: int, steps: int = 80, l2: float = 1e-3) -> tuple[np.ndarray, float, np.ndarray]:
    """Conditional log-likelihood by gradient ascent (Adam); all windows
    advance together, one word a step."""
    n = len(windows)
    length = np.array([w.n for w in windows])
    lane = np.concatenate([np.full(len(w.at), i) for i, w in enumerate(windows)]).astype(np.int64)
    at = np.concatenate([np.array(w.at, np.int64) for w in windows])
    feature = np.concatenate([np.array(w.feature, np.int64) for w in windows])
    label = np.zeros((n, WINDOW), np.int64)
    for i, w in enumerate(windows):
        label[i, w.toxic_at] = 1
    inside = np.arange(WINDOW)[None, :] < length[:, None]
    pair_of = np.concatenate((np.zeros((n, 1), np.int64), label[:, :-1]), axis=1) * 2 + label
    seen_pairs = np.bincount(pair_of[inside], minlength=4).reshape(2, 2)
    seen_features = np.bincount(feature, weights=label[lane, at], minlength=n_features)
    seen_bias = float(label[inside].sum())
    params = np.concatenate((np.full(n_features, 1.0), [-3.0], [0.0, -1.0, 0.0, 0.0]))
    m, v = np.zeros_like(params), np.zeros_like(params)
    for t in range(1, steps + 1):
        w, bias, moves = params[:n_features], params[n_features], params[n_features + 1 :].reshape(2, 2)
        emission = np.full((n, WINDOW), bias)
        np.add.at(emission, (lane, at), w[feature])
        factor = np.exp(np.clip(emission, -40, 40))
        step = np.exp(moves)
        alpha = np.zeros((WINDOW, n, 2))
        a = np.tile([1.0, 0.0], (n, 1))
        for i in range(WINDOW):
            b = a @ step
            b[:, 1] *= factor[:, i]
            b /= b.sum(axis=1, keepdims=True)
            a = np.where(inside[:, i : i + 1], b, a)
            alpha[i] = a
        beta = np.ones((n, 2))
        expected_pairs, toxic = np.zeros((2, 2)), np.zeros((n, WINDOW))
        for i in range(WINDOW - 1, -1, -1):
            p = alpha[i] * beta
            p /= p.sum(axis=1, keepdims=True)
            toxic[:, i] = p[:, 1] * inside[:, i]
            weighted = beta.copy()
            weighted[:, 1] *= factor[:, i]
            before = alpha[i - 1] if i else np.tile([1.0, 0.0], (n, 1))
            joint = before[:, :, None] * step[None] * weighted[:, None, :]
            joint /= joint.sum(axis=(1, 2), keepdims=True)
            expected_pairs += joint[inside[:, i]].sum(axis=0)
            back = weighted @ step.T
            beta = np.where(inside[:, i : i + 1], back / back.sum(axis=1, keepdims=True), beta)
        expected = np.bincount(feature, weights=toxic[lane, at], minlength=n_features)
        g = np.concatenate((seen_features - expected, [seen_bias - toxic.sum()], (seen_pairs - expected_pairs).ravel())) / n - l2 * params
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        params = params + 0.15 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return params[:n_features], float(params[n_features]), params[n_features + 1 :].reshape(2, 2)


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> ToxicityModel:
    """Fit features, chain and calibration on at most ``rows`` labelled
    documents. ``docs`` and ``labels`` hold only rows to learn from."""
    marks = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sample = bounded_sample(docs.select("doc_id", "text").join(marks, "doc_id"), "doc_id", rows).select("text", "toxic", "doc_id").persist()
    try:
        n = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
        a, b = n.get(1, 0), n.get(0, 0)
        empty = ToxicityModel([], np.zeros(0), -3.0, np.zeros((2, 2)))
        if not a or not b:
            return empty
        support = max(3, round(0.004 * a))
        common = (sample.where("toxic = 1").select("text", "toxic").mapInArrow(document_features, "feature binary, toxic long, other long")
                  .groupBy("feature").agg(F.sum("toxic").alias("toxic")).where(F.col("toxic") >= support))
        # frequent in toxic documents: at most their words over the support
        found = {bytes(r.feature): r.toxic for r in common.collect()}
        other = {bytes(r.feature): r.other for r in sample.where("toxic = 0").select("text").mapInArrow(rest_features(set(found)), "feature binary, other long")
                 .groupBy("feature").agg(F.sum("other").alias("other")).collect()}
        odds = {f: np.log((t + 0.5) / (a + 1)) - np.log((other.get(f, 0) + 0.5) / (b + 1)) for f, t in found.items()}
        chosen = sorted((f for f, o in odds.items() if o >= KEEP_LOG_ODDS), key=lambda f: (-odds[f] * np.sqrt(found[f]), f))[:FEATURES]
        if not chosen:
            return empty
        log_odds = [float(odds[f]) for f in chosen]
        windows = (sample.mapInArrow(training_windows(chosen, log_odds), "doc_id long, start long, n long, at array<long>, feature array<long>, toxic_at array<long>")
                   .orderBy(F.xxhash64("doc_id", "start"), "doc_id", "start").limit(WINDOWS).collect())
        model = ToxicityModel(chosen, *fit_chain(windows, len(chosen)))
        rows_of = sample.mapInArrow(summaries(model), "doc_id long, toxic int, x0 double, x1 double, x2 double").orderBy("doc_id", "x0", "x1", "x2").collect()
        x = np.array([[r.x0, r.x1, r.x2] for r in rows_of])
        y = np.array([r.toxic for r in rows_of], float)
        scale = x.std(axis=0) + 1e-9
        w, bias = logistic_fit(x / scale, y, np.ones(len(y)), l2=1e-4, steps=600)
        model.calibration = (w / scale, bias)
        return model
    finally:
        sample.unpersist()


def summaries(model: ToxicityModel) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, toxic, doc_id in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                n, telling = model.telling(text or "")
                rows.append((doc_id, toxic, *model.summary(n, model.marginals(n, telling))))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 5, (pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.float64()), strict=True)], ["doc_id", "toxic", "x0", "x1", "x2"])
    return run


SCORED = "doc_id long, score double, spans array<struct<start:long,end:long,marginal:double>>"


def score_text(model: ToxicityModel, text: str) -> tuple[float, list[dict]]:
    """Score and toxic spans (code points) of one text."""
    n, telling = model.telling(text)
    marginals = model.marginals(n, telling)
    hits = {i: p for (i, _), p in zip(telling, marginals, strict=True) if p >= SPAN_MARGINAL}
    spans = []
    if hits:
        spans = [{"start": m.start(), "end": m.end(), "marginal": hits[i]} for i, m in enumerate(WORD.finditer(text)) if i in hits]
    return model.score(n, marginals), spans


def score_batches(model: ToxicityModel) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("marginal", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [score_text(model, t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], span)], ["doc_id", "score", "spans"])
    return run


def score_documents(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score and toxic spans of every row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score_batches(model), SCORED)


def accept_batches(model: ToxicityModel, threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.filter(pa.array([score_text(model, t or "")[0] < threshold for t in texts], pa.bool_()))
    return run


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """``docs`` (all columns) without the rows that score the threshold or more."""
    return docs.mapInArrow(accept_batches(model, threshold), docs.schema)
