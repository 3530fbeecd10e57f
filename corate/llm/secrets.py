"""Secret scans: fixed rules plus a pair of character Markov models.

The rules give the base spans. The method adds spans: what the rules leave
of every long run of token characters is scored by two first-order Markov
models, one of random strings and one of ordinary identifiers, and is
reported when the log-likelihood ratio speaks for a random string. Without
a digit the ratio must be stricter; without a letter it is a number or a
line and is left alone. The models are trained from labelled samples
``(token, label)``.

Defined results: NULL or empty text has no spans; a run is never cut, so a
very long token is one span; spans of the method never overlap base spans;
equal rows give equal results; with no labelled random strings the random
model is uniform, with no labelled identifiers that model is uniform.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corate.llm.common import binary_texts, bounded_sample

# The base rules, in the order in which ties are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
#: A greedy run of 24 or more is exactly a run of one or more that passes.
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "markov")

# The method's candidates and thresholds.
TOKEN_CHARS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_=-."
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}", re.ASCII)
LEAST_RATIO = 8.0
LEAST_RATIO_PER_CHAR = 0.25
#: The same for runs without a digit, which words may be: over their distinct
#: transitions, of which a letter or syllable repeated has few.
LEAST_TRANSITIONS = 8
LEAST_RATIO_PER_TRANSITION = 1.0
IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]{5,}", re.ASCII)

#: Documents from which the labelled samples are drawn.
FIT_DOCUMENTS = 20_000

SPANS = "array<struct<kind:string,start:long,end:long>>"


def base_spans(text: str, raw: bytes) -> list[tuple[int, int, int]]:
    """(start, rank of kind, end) of the base rules' spans, sorted."""
    spans = []
    lower = raw.lower()
    if any(w in lower for w in ASSIGN_WORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
    if b"AKIA" in raw:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


class MarkovPair:
    """Log-likelihood ratio of a random string against an identifier."""

    def __init__(self, ratio: np.ndarray):
        self.ratio = ratio.tolist()
        self.code = {c: i + 1 for i, c in enumerate(TOKEN_CHARS)}

    @classmethod
    def from_counts(cls, random: dict[tuple[int, int], int], ordinary: dict[tuple[int, int], int]) -> MarkovPair:
        """Each transition is smoothed, that of random strings by a whole
        count: labelled ones are few, and what they happen not to hold is no
        less random. With no counts it is uniform. State 0 is the start."""
        n = len(TOKEN_CHARS) + 1
        logs = []
        for counts, least in ((random, 1.0), (ordinary, 0.05)):
            table = np.full((n, n), least)
            for (a, b), c in counts.items():
                table[a, b] += c
            logs.append(np.log(table[:, 1:] / table[:, 1:].sum(axis=1, keepdims=True)))
        return cls(np.pad(logs[0] - logs[1], ((0, 0), (1, 0))))

    def score(self, token: str) -> float:
        total, before, code, ratio = 0.0, 0, self.code, self.ratio
        for c in token:
            now = code[c]
            total += ratio[before][now]
            before = now
        return total

    def is_secret(self, token: str) -> bool:
        """The models decide; only numbers and lines, which hold no letter
        and of which neither model knows anything, are left alone."""
        if not any(c.isalpha() for c in token):
            return False
        if any(c.isdigit() for c in token):
            return self.score(token) >= max(LEAST_RATIO, LEAST_RATIO_PER_CHAR * len(token))
        codes = [0, *(self.code[c] for c in token)]
        once = set(itertools.pairwise(codes))
        return len(once) >= LEAST_TRANSITIONS and sum(self.ratio[a][b] for a, b in sorted(once)) >= LEAST_RATIO_PER_TRANSITION * len(once)


def labelled_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Transition counts of one task's labelled samples: values that a base
    rule found are random strings (label 1), identifiers outside the spans
    are ordinary (label 0)."""
    code = {c: i + 1 for i, c in enumerate(TOKEN_CHARS)}
    counts: Counter[tuple[int, int, int]] = Counter()
    for batch in batches:
        for raw in binary_texts(batch.column(0)):
            text = raw.decode()
            at, rest = 0, []
            for start, kind, end in base_spans(text, raw):
                rest.append(text[at:start])
                at = max(at, end)
                value = text[start:end]
                if kind == 0:
                    value = ASSIGN.match(value).group(2)
                _count(counts, 1, value, code)
            rest.append(text[at:])
            for piece in rest:
                for m in IDENTIFIER.finditer(piece):
                    _count(counts, 0, m.group(), code)
    rows = [(*k, v) for k, v in counts.items()]
    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*rows, strict=True) if rows else [[]] * 4)], ["label", "a", "b", "n"])


def _count(counts: Counter, label: int, token: str, code: dict[str, int]) -> None:
    before = 0
    for c in token:
        now = code[c]
        counts[label, before, now] += 1
        before = now


def fit_markov(docs: DataFrame, documents: int = FIT_DOCUMENTS) -> MarkovPair:
    """Train both models from the samples in at most ``documents`` rows.
    What reaches the driver is one count per pair of characters and label."""
    sample = bounded_sample(docs.select("doc_id", "text"), "doc_id", documents)
    rows = (sample.select("text").mapInArrow(labelled_tokens, "label long, a long, b long, n long")
            .groupBy("label", "a", "b").agg(F.sum("n").alias("n")).collect())
    counts: tuple[dict, dict] = ({}, {})
    for r in rows:
        counts[r.label][r.a, r.b] = r.n
    return MarkovPair.from_counts(counts[1], counts[0])


def all_spans(text: str, raw: bytes, model: MarkovPair) -> list[tuple[int, int, int]]:
    """Base spans and the method's, sorted by start, then kind."""
    base = base_spans(text, raw)
    extra = []
    first = 0
    for m in CANDIDATE.finditer(text):
        at, end = m.span()
        # base spans are sorted by start; a span may reach over several runs
        while first < len(base) and base[first][2] <= at:
            first += 1
        for start, _, stop in itertools.chain(itertools.islice(base, first, None), [(end, 0, end)]):
            start = min(start, end)
            if at < start and model.is_secret(text[at:start]):
                extra.append((at, 3, start))
            at = max(at, stop)
            if start == end:
                break
    return sorted(base + extra) if extra else base


def scan(model: MarkovPair) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    kind_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for raw in binary_texts(batch.column(1)):
                spans = all_spans(raw.decode(), raw, model)
                found.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind_type)], ["doc_id", "spans"])
    return run


def find_secrets(docs: DataFrame, model: MarkovPair) -> DataFrame:
    """doc_id and the spans (kind, start, end in code points) of every row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan(model), f"doc_id long, spans {SPANS}")


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def secret_digest(found: DataFrame) -> DataFrame:
    """The counts, the digest of the base spans and all spans as text."""
    def n(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")

    base = F.filter("spans", lambda s: s.kind != "markov")
    return found.select(
        "doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
        F.sha2(spans_text(base).cast("binary"), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
        n("markov").alias("n_markov"),
    )


def redact(model: MarkovPair, mark: str = "[SECRET]") -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Replace every span by ``mark``; overlapping spans become one mark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            column = batch.column(at)
            out = []
            for raw, null in zip(binary_texts(column), column.is_null().to_pylist(), strict=True):
                text, parts, done = raw.decode(), [], 0
                for start, _, end in all_spans(text, raw, model):
                    if start >= done:
                        parts += [text[done:start], mark]
                    done = max(done, end)
                out.append(None if null else "".join([*parts, text[done:]]))
            yield batch.set_column(at, batch.schema.field(at), pa.array(out, batch.schema.field(at).type))
    return run


def redact_secrets(docs: DataFrame, model: MarkovPair) -> DataFrame:
    """``docs`` with all columns, secrets in ``text`` replaced by a mark and
    n_chars counted anew where it is there and the text changed."""
    out = docs.mapInArrow(redact(model), docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out
