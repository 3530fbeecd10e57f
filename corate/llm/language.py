"""Language identification by cross-parsing entropy.

A suffix automaton of each language's labelled text answers longest-match
questions: starting anywhere in a document, how far does it run on in text
of that language? Parsing a document into such longest matches takes few
phrases in its own language and many in others. Phrases times the bits of
a phrase pointer (log2 of the automaton's text) per byte is the cross
entropy; the language with the least wins.

Texts are parsed whole. All texts of a block advance together, one byte a
step, in every language; a long text is parsed in several lanes (a phrase
ends at a lane's end), whose phrases add up.

Defined results: NULL text or a text without a letter is ``und`` with score
0; so is every text if nothing was learned; ties go to the alphabetically
first language; equal rows give equal results.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate.llm.common import binary_texts

#: Labelled text of one language: bytes of the automaton's text at most, rows
#: that share them at least (where there are so many), and bytes of a slice.
FIT_ROWS = 60
FIT_BYTES = 24_000
#: Bytes of the table of all languages' automata; where FIT_BYTES of each
#: would take more, every language has an equal share.
MODEL_BYTES = 256 << 20
FIT_SLICE = FIT_BYTES // FIT_ROWS
#: Parts in which a language's slices are merged before they meet.
FIT_PARTS = 16
#: Bytes of a lane, and lanes' bytes of a block.
LANE = 2048
BLOCK = 6 << 20
#: Sharpness of the score's soft maximum, per bit of cross entropy a byte.
SHARPNESS = 12.0

LETTER = re.compile(r"[^\W\d_]")


def symbols() -> np.ndarray:
    """Class of each byte: letters stand for themselves, all other ASCII
    bytes for a blank (class 0)."""
    table = np.zeros(256, np.uint8)
    table[ord("a") : ord("z") + 1] = np.arange(1, 27)
    table[0x80:] = np.arange(27, 155)
    return table


def suffix_automaton(data: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings of ``data``."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in data:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return moves


def share_of(languages: int, width: int, model_bytes: int) -> int:
    """Bytes of text that each of so many languages may learn from, so that
    their automata (two states a byte at most, ``width`` entries of four
    bytes a state) stay within ``model_bytes`` together."""
    return max(1, min(FIT_BYTES, model_bytes // (max(1, languages) * 8 * width)))


class LanguageModel:
    """One table for all languages: entry (state, class) is the next state,
    or, where no match goes on, the complement of the state after the root
    takes the class (a new phrase starts).

    The table never holds more than ``model_bytes``: of many languages each
    has a smaller share of text. Its entries therefore fit 32 bits."""

    def __init__(self, texts: dict[str, str], model_bytes: int = MODEL_BYTES):
        if model_bytes > 1 << 32:
            raise ValueError("entries of a model beyond 4 GB don't fit 32 bits")
        self.languages = sorted(k for k, v in texts.items() if v)
        table, n_classes = symbols(), 155
        share = share_of(len(self.languages), n_classes + 1, model_bytes)
        coded = {k: table[np.frombuffer(texts[k].lower().encode()[:share], np.uint8)] for k in self.languages}
        seen = np.zeros(n_classes, bool)
        seen[0] = True
        for v in coded.values():
            seen[v] = True
        # classes that no language has seen share one column
        self.width = int(seen.sum()) + 1
        narrow = np.full(n_classes, self.width - 1, np.uint8)
        narrow[seen] = np.arange(self.width - 1)
        self.classes = narrow[table]
        parts, self.roots, base = [], [], 0
        for k in self.languages:
            moves = suffix_automaton(narrow[coded[k]].tolist())
            part = np.full((len(moves), self.width), -1, np.int32)
            for s, m in enumerate(moves):
                part[s, list(m)] = list(m.values())
            root = np.where(part[0] < 0, 0, part[0]) + np.int32(base)
            new_phrase = ~(root * np.int32(self.width))
            parts.append(np.where(part < 0, new_phrase[None, :], (part + np.int32(base)) * np.int32(self.width)).ravel())
            self.roots.append(base * self.width)
            base += len(moves)
        # entries are premultiplied by the width: next entry = state + class
        self.table = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        self.pointer_bits = np.log2(np.array([max(2, len(coded[k])) for k in self.languages], float))

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Phrases of each lower-cased text in each language."""
        lanes = [(i, t[at : at + LANE]) for i, t in enumerate(texts) for at in range(0, len(t), LANE)]
        lanes.sort(key=lambda x: -len(x[1]))
        out = np.zeros((len(texts), len(self.languages)))
        if not lanes or not self.languages:
            return out
        lengths = np.array([len(x) for _, x in lanes])
        grid = np.zeros((len(lanes), lengths[0]), np.uint8)
        flat = self.classes[np.frombuffer(b"".join(x for _, x in lanes), np.uint8)]
        grid[np.arange(lengths[0])[None, :] < lengths[:, None]] = flat
        grid = np.ascontiguousarray(grid.T)
        active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
        owner = np.array([i for i, _ in lanes])
        for j, root in enumerate(self.roots):
            state = np.full(len(lanes), root, np.int32)
            count = np.ones(len(lanes), np.int32)
            for step in range(lengths[0]):
                k = active[step]
                move = self.table[state[:k] + grid[step, :k]]
                sign = move >> 31
                state[:k] = move ^ sign
                count[:k] -= sign
            out[:, j] = np.bincount(owner, weights=count, minlength=len(texts))
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        raw = [(t or "").lower().encode() for t in texts]
        bits = self.phrases(raw) * self.pointer_bits / np.maximum(1, [len(r) for r in raw])[:, None]
        names, scores = [], []
        for text, b in zip(texts, bits, strict=True):
            if not text or not self.languages or not has_letter(text):
                names.append("und")
                scores.append(0.0)
                continue
            best = int(np.argmin(b))
            names.append(self.languages[best])
            scores.append(float(1 / np.exp(-SHARPNESS * (b - b[best])).sum()))
        return names, scores


FITTED = "lang string, turn int, h long, slice string"


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in LETTER.finditer(text))


class Slices:
    """Of each language the slices with the smallest (turn, hash) that fill
    FIT_BYTES; equal slices count once. Merging such fillings gives the
    filling of all their rows, however the rows were dealt out."""

    def __init__(self):
        self.kept: dict[str, list[tuple[int, int, str]]] = {}
        self.size: dict[str, int] = {}
        self.last: dict[str, tuple[int, int]] = {}

    def wants(self, lang: str, turn: int, h: int) -> bool:
        return lang not in self.last or (turn, h) <= self.last[lang]

    def add(self, lang: str, turn: int, h: int, text: str) -> None:
        self.kept.setdefault(lang, []).append((turn, h, text))
        self.size[lang] = self.size.get(lang, 0) + len(text.encode()) + 1
        if self.size[lang] > 4 * FIT_BYTES:
            self.shrink(lang)

    def shrink(self, lang: str) -> None:
        keep, seen, size = [], set(), 0
        for turn, h, text in sorted(self.kept[lang]):
            if text not in seen:
                seen.add(text)
                keep.append((turn, h, text))
                size += len(text.encode()) + 1
                if size >= FIT_BYTES:
                    self.last[lang] = (turn, h)
                    break
        self.kept[lang], self.size[lang] = keep, size

    def batch(self) -> pa.RecordBatch:
        for lang in self.kept:
            self.shrink(lang)
        rows = [(lang, *x) for lang, kept in self.kept.items() for x in kept]
        types = (pa.string(), pa.int32(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 4, types, strict=True)], ["lang", "turn", "h", "slice"])


def cut_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of rows (lang, h, text), anywhere in the text: the hash says
    where a row's first slice lies, and further turns go evenly round the
    text. A row that offers no letter in its turns gives its first letter."""
    out = Slices()
    for batch in batches:
        for lang, h, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), binary_texts(batch.column(2)), strict=True):
            cells = -(-len(raw) // FIT_SLICE)
            turns, lettered = min(cells, FIT_ROWS), False
            for turn in range(turns):
                if not out.wants(lang, turn, h):
                    break
                at = (h + turn * (cells // turns)) % cells * FIT_SLICE
                piece = raw[at : at + FIT_SLICE].decode(errors="ignore")
                if has_letter(piece):
                    lettered = True
                    out.add(lang, turn, h, piece)
            else:
                if not lettered:
                    text = raw.decode()
                    at = next((m.start() for m in LETTER.finditer(text) if m.group().isalpha()), None)
                    if at is not None:
                        out.add(lang, turns, h, text[at : at + FIT_SLICE].encode()[:FIT_SLICE].decode(errors="ignore"))
    yield out.batch()


def merge_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = Slices()
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if out.wants(*row[:3]):
                out.add(*row)
    yield out.batch()


def fit_languages(docs: DataFrame) -> LanguageModel:
    """Learn from text and lang of ``docs``: of each language slices of
    FIT_SLICE bytes, chosen by hash, until FIT_BYTES are full. Every row
    gives its first slice before any gives a second; a row of any length
    takes part, and every language with a labelled row has a model."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    slices = usable.select("lang", F.xxhash64("doc_id", "text", F.lit("lang")).alias("h"), "text").mapInArrow(cut_slices, FITTED)
    merged = slices.repartition("lang", F.pmod("h", F.lit(FIT_PARTS))).mapInArrow(merge_slices, FITTED)
    texts: dict[str, list[str]] = {}
    for r in sorted(merged.repartition("lang").mapInArrow(merge_slices, FITTED).collect()):
        texts.setdefault(r.lang, []).append(r.slice)
    return LanguageModel({k: "\n".join(v) for k, v in texts.items()})


PREDICTED = "doc_id long, lang_pred string, score double"


def predict_batches(broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = broadcast.value
        for batch in batches:
            texts, first, size = batch.column(1).to_pylist(), 0, 0
            for i in range(len(texts) + 1):
                if i == len(texts) or size > BLOCK:
                    if i > first:
                        names, scores = model.predict(texts[first:i])
                        yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, i - first), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])
                    first, size = i, 0
                if i < len(texts):
                    size += len(texts[i] or "")
    return run


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, predicted language and score of every row. The broadcast
    automata are bounded by MODEL_BYTES, however many languages there are."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(predict_batches(shipped), PREDICTED)
