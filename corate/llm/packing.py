"""Best-fit packing by minimum bin slack.

Tokenising gives every piece's length (at most the capacity). Pieces of one
length are interchangeable, so packing needs only how many pieces there are
of each length: at most ``capacity`` numbers, whatever the corpus holds.
Per bin, the longest piece left is the seed; a bitset subset-sum over the
lengths left finds the fullest feasible combination with it, which is then
removed - as often as the counts allow, since the next search would find
the same combination again. The result is a table of slots (length, rank
range, bin, offset); each piece finds its slot by its rank among the pieces
of its length. Ranks come from per-task counters and per-task counts, so no
task ever gathers the pieces of one length.

Defined results: NULL text counts as empty; an empty text is one piece that
holds only the end id; an empty table gives an empty result; repeated rows
are packed once each.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corate.config import materialize
from corate.llm.common import SLICE_BYTES, blocks, text_slices

CAPACITY = 4096
END_ID = 1
#: Entries after which a worker's word cache starts anew (bounds its memory).
CACHE_ENTRIES = 600_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, local_rank long"


class WordTokenizer:
    """Ids of whole texts by a tokenizer that splits words, single digits and
    runs of punctuation, drops blanks and folds case.

    A text of plain characters is cut into those parts in one pass; ids of
    each distinct part are learned once, many parts in one call, and kept as
    bytes (little-endian unsigned 32-bit). In other texts, blanks still
    separate chunks that are encoded on their own."""

    #: Letters and punctuation that folding case and composing keep one to
    #: one; what else a text holds makes its chunk one to encode as it is.
    LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
    PUNCTUATION = r"!-/:-@\[-`{-~"
    ODD = re.compile(f"[^0-9{LETTERS}{PUNCTUATION} \n]|<\\|(?:start|end)oftext\\|>")
    # The endings that the tokenizer cuts off first.
    PARTS = re.compile(f"[{LETTERS}]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[{PUNCTUATION}]+")
    SUFFIX = "</w>"

    def __init__(self, definition: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith(self.SUFFIX)]] = True
        self.ids: dict[str, bytes] = {}

    def parts(self, text: str, odd: set[str]) -> list[str]:
        """What a slice of text is cut into; odd chunks stay whole and are
        added to ``odd``."""
        if not self.ODD.search(text):
            return self.PARTS.findall(text.lower())
        out = []
        for chunk in text.replace("\n", " ").split(" "):
            if self.ODD.search(chunk):
                odd.add(chunk)
                out.append(chunk)
            else:
                out += self.PARTS.findall(chunk.lower())
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(texts) == 1 and len(texts[0]) > 2 * SLICE_BYTES:
            return [b"".join(self._encode([s])[0] for s in text_slices(texts[0]))]
        return self._encode(texts)

    def _encode(self, texts: list[str]) -> list[bytes]:
        odd: set[str] = set()
        cut = [self.parts(t, odd) for t in texts]
        if len(self.ids) > CACHE_ENTRIES:
            self.ids = {}
        missing = set().union(*cut).difference(self.ids)
        self._learn(list(missing.difference(odd)), list(missing.intersection(odd)))
        get = self.ids.__getitem__
        return [b"".join(map(get, c)) for c in cut]

    def _learn(self, plain: list[str], odd: list[str]) -> None:
        """Encode many parts as one text: each is one pre-token, whose last
        token has the word-end mark. Odd chunks are encoded one by one."""
        texts = [plain[i : i + 400] for i in range(0, len(plain), 400)]
        for part, e in zip(texts, self.tokenizer.encode_batch_fast([" ".join(t) for t in texts], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, "<u4")
            raw, cut = ids.tobytes(), (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(cut) != len(part):
                # some part isn't one pre-token: each is encoded as it is
                odd = odd + part
                continue
            self.ids.update({p: raw[a:b] for p, a, b in zip(part, [0, *cut], cut, strict=False)})
        for first in range(0, len(odd), 1000):
            part = odd[first : first + 1000]
            for p, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.ids[p] = np.array(e.ids, "<u4").tobytes()


_tokenizers: dict[int, WordTokenizer] = {}


def cut_pieces(definition, capacity: int, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pieces of every text, with the task and the rank among the task's
    pieces of that length. ``definition`` is a broadcast tokenizer file."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        text_of = definition.value
        key = zlib.crc32(text_of.encode())
        if key not in _tokenizers:
            _tokenizers[key] = WordTokenizer(text_of)
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ids = batch.column(0).to_pylist()
            for a, b in blocks(texts):
                rows = []
                for doc_id, coded in zip(ids[a:b], _tokenizers[key].encode(texts[a:b]), strict=True):
                    data = memoryview(coded + end)
                    for piece, start in enumerate(range(0, len(data), 4 * capacity)):
                        part = data[start : start + 4 * capacity]
                        n = len(part) // 4
                        rows.append((doc_id, piece, start // 4, n, zlib.crc32(part), task, int(seen[n])))
                        seen[n] += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()), strict=True)],
                    [f.split()[0] for f in PIECES.split(", ")])
    return run


@dataclass(frozen=True)
class Pattern:
    """A combination of lengths that fills ``bins`` bins alike."""

    lengths: tuple[tuple[int, int], ...]  # (length, how many in a bin)
    bins: int


def fullest(counts: dict[int, int], capacity: int) -> list[tuple[int, int]]:
    """The available lengths (length, number) whose sum is as near to
    ``capacity`` as possible, by bitset subset-sum. Lengths are taken
    longest first and the search ends once a sum is exact."""
    reach, mask, steps = 1, (1 << (capacity + 1)) - 1, []
    for length in sorted((n for n in counts if n <= capacity), reverse=True):
        left, size = min(counts[length], capacity // length), 1
        while left:
            take = min(size, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left -= take
            size *= 2
            if reach >> capacity & 1:
                left = 0
        if reach >> capacity & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            total -= length * take
            chosen[length] = chosen.get(length, 0) + take
    return sorted(chosen.items(), reverse=True)


def minimum_bin_slack(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that pack all pieces of a histogram of lengths."""
    left = {n: c for n, c in histogram.items() if c}
    patterns = []
    while left:
        seed = max(left)
        left[seed] -= 1
        chosen = dict(fullest({n: c for n, c in left.items() if c and n <= capacity - seed}, capacity - seed))
        left[seed] += 1
        chosen[seed] = chosen.get(seed, 0) + 1
        bins = min(left[n] // m for n, m in chosen.items())
        patterns.append(Pattern(tuple(sorted(chosen.items(), reverse=True)), bins))
        for n, m in chosen.items():
            left[n] -= m * bins
            if not left[n]:
                del left[n]
    return patterns


def slots(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """For each length, which rank range goes to which bins and offset.
    Sorted by (length, first rank)."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for p in patterns:
        offset = 0
        for length, m in p.lengths:
            first = used.get(length, 0)
            rows.append((length, first, m, sequence, offset))
            used[length] = first + m * p.bins
            offset += length * m
        sequence += p.bins
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return {k: table[:, i].copy() for i, k in enumerate(("length", "first", "per_bin", "sequence", "offset"))}


def place(slot_table) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sequence and offset of each piece by its rank within its length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = slot_table.value
        key = (s["length"] << 48) + s["first"]
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (3, 5))
            at = np.searchsorted(key, (length << 48) + rank, side="right") - 1
            inside = rank - s["first"][at]
            yield pa.RecordBatch.from_arrays([
                *(batch.column(i) for i in range(5)),
                pa.array(s["sequence"][at] + inside // s["per_bin"][at], pa.int64()),
                pa.array(s["offset"][at] + inside % s["per_bin"][at] * length, pa.int64()),
            ], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return run


PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) and their places in sequences."""
    sc = docs.sparkSession.sparkContext
    with open(tokenizer_file, encoding="utf-8") as f:
        definition = sc.broadcast(f.read())  # a file of fixed size
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = materialize(rows.mapInArrow(cut_pieces(definition, capacity, end_id), PIECES), "pieces")
    per_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    # at most `capacity` rows, one a length
    histogram = {r.length: r.n for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = sc.broadcast(slots(minimum_bin_slack(histogram, capacity)))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = pieces.join(offsets, ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("local_rank")).alias("rank"))
    return ranked.mapInArrow(place(table), PACKED)
