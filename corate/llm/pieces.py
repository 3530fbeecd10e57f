"""SentencePiece encoding with source offsets, and decoding.

A text is normalised by the longest prefix that the model's compiled
character map (a double-array trie) knows at each place; every normalised
byte records the source byte it came from. The normalised text is cut where
no piece of the vocabulary can reach across, each segment is merged by
byte-pair encoding in order of piece scores, and every piece is projected
back to a span of source bytes.

Defined results: NULL or empty text has no ids, no spans and decodes to the
empty text; a segment of any length is encoded whole (a heap orders its
merges); equal rows give equal results; an empty table an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate.llm.common import blocks

SPACE = "▁"
CACHE_ENTRIES = 600_000
# Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class CharacterMap:
    """The compiled map: a double-array trie over source bytes whose values
    are places in a pool of NUL-ended replacements. Empty: the identity."""

    def __init__(self, blob: bytes):
        self.empty = not blob
        if self.empty:
            return
        size = struct.unpack_from("<I", blob)[0]
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4)
        self.pool = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes]:
        """(source bytes, replacement) of the longest known prefix at ``at``;
        without one, a single code point stands for itself."""
        if not self.empty:
            best = self._walk(data, at)
            if best:
                length, place = best
                return length, self.pool[place : self.pool.index(b"\0", place)]
        first = data[at]
        length = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        return length, data[at : at + length]

    def _walk(self, data: bytes, at: int) -> tuple[int, int] | None:
        units, best = self.units, None
        node = _offset(units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            unit = units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= _offset(unit)
            if unit >> 8 & 1:
                best = i - at + 1, units[node] & 0x7FFFFFFF
        return best


def _offset(unit: int) -> int:
    """Where a unit's children are in the double array."""
    return (unit >> 10) << ((unit & 0x200) >> 6)


class PieceModel:
    """Vocabulary, character map and spacing rules of a model file."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as proto

        m = proto.ModelProto()
        m.ParseFromString(model)
        if m.trainer_spec.model_type != proto.TrainerSpec.BPE:
            raise ValueError("only BPE models are encoded here")
        spec = m.normalizer_spec
        self.charmap = CharacterMap(spec.precompiled_charsmap)
        self.dummy_prefix, self.trim = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.byte_fallback = m.trainer_spec.byte_fallback
        self.pieces = [p.piece for p in m.pieces]
        self.kinds = [p.type for p in m.pieces]
        self.unknown = self.kinds.index(UNKNOWN)
        self.unknown_surface = m.trainer_spec.unk_surface
        mergeable = [i for i, k in enumerate(self.kinds) if k in (NORMAL, USER_DEFINED)]
        self.ids = {self.pieces[i]: i for i in mergeable}
        # merges go by falling score: a rank, 0 the best
        scores = {m.pieces[i].score for i in mergeable}
        order = {s: r for r, s in enumerate(sorted(scores, reverse=True))}
        self.rank = {self.pieces[i]: order[m.pieces[i].score] for i in mergeable}
        if any(k in (USER_DEFINED, UNUSED) for k in self.kinds):
            raise ValueError("models with user-defined or unused pieces are not supported")
        if len(self.pieces) > 1 << 16:
            raise ValueError("models of more than 65,536 pieces are not supported: ids are kept in 16 bits")
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == BYTE}
        #: no piece reaches from another character across a space mark
        self.cut_at_space = not any(SPACE in p[i:] and p[i - 1] != SPACE and p[i] == SPACE for p in self.ids for i in range(1, len(p)))
        self.cut_at_line = not any("\n" in p and len(p) > 1 for p in self.ids)
        # decoding: bytes of each id
        self.surface = [b"" if k == CONTROL else self.unknown_surface.encode() if k == UNKNOWN else bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(SPACE, " ").encode()
                        for p, k in zip(self.pieces, self.kinds, strict=True)]
        self.text_of_id = [str(i) for i in range(len(self.pieces))]
        self.source_length = np.array([len(s) for s in self.surface], np.int64)
        self.cache: dict[str, bytes] = {}
        #: texts without space marks of their own or runs of blanks map one to
        #: one, and may be cut at blanks, line ends and before punctuation
        self.plain = self.charmap.empty and not self.trim and self.dummy_prefix and self.cut_at_space and self.cut_at_line
        stops = re.escape("".join(sorted(self._stops())))
        self.segment = re.compile(f" ?[^ \n{stops}]+| ?[{stops}]+[^ \n{stops}]*|[ \n]" if stops else " ?[^ \n]+|[ \n]")

    def _stops(self) -> set[str]:
        """Punctuation that follows, in every piece, only its like or a space
        mark: no merge reaches across a place before it."""
        stops = {c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum()}
        pairs = {(a, b) for p in self.ids for a, b in zip(p, p[1:], strict=False)}
        while bad := {b for a, b in pairs if b in stops and a not in stops and a != SPACE}:
            stops -= bad
        return stops

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """Normalised text, and for every byte of it (and its end) the source
        byte where what it came from starts."""
        data, out, source = text.encode(), bytearray(), []
        mark, at, n = SPACE.encode(), 0, len(text.encode())
        if not n:
            return "", np.zeros(1, np.int64)
        if self.trim:
            while at < n:
                length, new = self.charmap.longest(data, at)
                if new.strip(b" "):
                    break
                at += length
            if at == n:
                return "", np.array([n])
        if self.dummy_prefix:
            out += mark
            source += [at] * 3
        blank = self.trim
        while at < n:
            length, new = self.charmap.longest(data, at)
            while blank and new.startswith(b" "):
                new = new[1:]
            for c in new:
                piece = mark if c == 0x20 else bytes([c])
                out += piece
                source += [at] * len(piece)
            if new:
                blank = self.trim and new.endswith(b" ")
            at += length
        if self.trim:
            while out.endswith(mark):
                del out[-3:]
                n = source[-3]
                del source[-3:]
        return out.decode(), np.array([*source, n], np.int64)

    def merge(self, segment: str) -> list[int]:
        """Byte-pair encoding: the best-scored neighbours merge first, the
        leftmost of equals."""
        parts = list(segment)
        if len(parts) > 40:
            parts = self._merge_long(parts)
        else:
            rank = self.rank
            pairs = [rank.get(a + b, 1 << 30) for a, b in zip(parts, parts[1:], strict=False)]
            while pairs:
                best = min(pairs)
                if best == 1 << 30:
                    break
                i = pairs.index(best)
                parts[i] += parts.pop(i + 1)
                pairs.pop(i)
                if i:
                    pairs[i - 1] = rank.get(parts[i - 1] + parts[i], 1 << 30)
                if i < len(pairs):
                    pairs[i] = rank.get(parts[i] + parts[i + 1], 1 << 30)
        out = []
        for p in parts:
            i = self.ids.get(p)
            if i is not None:
                out.append(i)
            elif self.byte_fallback:
                out += [self.bytes[b] for b in p.encode()]
            else:
                out.append(self.unknown)
        return out

    def _merge_long(self, parts: list[str]) -> list[str]:
        n, rank = len(parts), self.rank
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = []

        def offer(i: int, j: int) -> None:
            r = rank.get(parts[i] + parts[j])
            if r is not None:
                heapq.heappush(heap, (r, i, j, len(parts[i]) + len(parts[j])))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, size = heapq.heappop(heap)
            if not parts[i] or not parts[j] or after[i] != j or len(parts[i]) + len(parts[j]) != size:
                continue
            parts[i] += parts[j]
            parts[j] = ""
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
                offer(i, after[j])
            if before[i] >= 0:
                offer(before[i], i)
        return [p for p in parts if p]

    def encode_normalised(self, text: str) -> list[int]:
        segments = re.findall(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+", text) if self.cut_at_space else [text] if text else []
        return [i for s in segments for i in self.merge(s)]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of a text, and start and end of each piece's source bytes."""
        if not text:
            return np.zeros(0, "<u2"), np.zeros(0, np.int64), np.zeros(0, np.int64)
        if self.plain and SPACE not in text and "  " not in text and text[0] != " ":
            ids = np.frombuffer(self._plain_ids(text), "<u2")
            ends = np.cumsum(self.source_length[ids]) - 1  # the prefix mark has no source
            starts = np.concatenate(([0], ends[:-1]))
            return ids, starts, ends
        normalised, source = self.normalise(text)
        ids = np.array(self.encode_normalised(normalised), "<u2")
        # a piece's normalised bytes, projected through the alignment
        mark = len(SPACE.encode()) - 1
        spaces = np.array([p.count(SPACE) if k == NORMAL else 0 for p, k in ((self.pieces[i], self.kinds[i]) for i in ids)], np.int64)
        if self.unknown in ids:
            return ids, *self._unknown_spans(normalised, source, ids)
        edges = np.concatenate(([0], np.cumsum(self.source_length[ids] + mark * spaces)))
        return ids, source[edges[:-1]], source[edges[1:]]

    def _unknown_spans(self, normalised: str, source: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Without byte fallback, an unknown piece is one character."""
        at, edges = 0, [0]
        for i in ids:
            at += 1 if i == self.unknown else len(self.pieces[i])
            edges.append(len(normalised[:at].encode()))
        return source[edges[:-1]], source[edges[1:]]

    def _plain_ids(self, text: str) -> bytes:
        """Ids as bytes, by segments whose merges don't depend on each other."""
        segments = self.segment.findall(" " + text)
        cache = self.cache
        if len(cache) > CACHE_ENTRIES:
            cache.clear()
        for s in set(segments).difference(cache):
            cache[s] = np.array(self.merge(s.replace(" ", SPACE)), "<u2").tobytes()
        return b"".join(map(cache.__getitem__, segments))

    def decode(self, ids: list[int]) -> str:
        """The text of ids: byte pieces join to characters, space marks
        become blanks, and the blank of the prefix goes."""
        data = b"".join(map(self.surface.__getitem__, ids))
        if self.dummy_prefix and ids and self.kinds[ids[0]] == NORMAL and data.startswith(b" "):
            data = data[1:]
        return data.decode("utf-8", "replace")


_models: dict[int, PieceModel] = {}


def model_of(broadcast) -> PieceModel:
    """The worker's model of a broadcast model file."""
    key = zlib.crc32(broadcast.value)
    if key not in _models:
        _models[key] = PieceModel(broadcast.value)
    return _models[key]


ENCODED = "doc_id long, ids array<int>, starts array<long>, ends array<long>"
DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, source_bytes long"


def encode_batches(broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(broadcast)
        for batch in batches:
            texts, ids = [t or "" for t in batch.column(1).to_pylist()], batch.column(0)
            for a, b in blocks(texts):
                coded = [model.encode(t) for t in texts[a:b]]
                yield pa.RecordBatch.from_arrays([
                    ids.slice(a, b - a),
                    pa.array([c[0].astype(np.int32) for c in coded], pa.list_(pa.int32())),
                    pa.array([c[1] for c in coded], pa.list_(pa.int64())),
                    pa.array([c[2] for c in coded], pa.list_(pa.int64())),
                ], ["doc_id", "ids", "starts", "ends"])
    return run


def digest_batches(broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Encode, decode and digest in one pass; no id leaves the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(broadcast)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids, _, ends = model.encode(text or "")
                ids = ids.tolist()
                rows.append((doc_id, len(ids), hashlib.sha256(",".join(map(model.text_of_id.__getitem__, ids)).encode()).hexdigest(),
                             hashlib.sha256(model.decode(ids).encode()).hexdigest(), int(ends[-1]) if ids else 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 5, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)],
                [f.split()[0] for f in DIGEST.split(", ")])
    return run


def load(docs: DataFrame, model_file: str):
    with open(model_file, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())  # a file of fixed size


def encode_documents(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, ids, and the source byte span of each piece."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(encode_batches(load(docs, model_file)), ENCODED)


def piece_digest(docs: DataFrame, model_file: str) -> DataFrame:
    """Digests of ids and of the decoded text; source_bytes is the end of
    the last piece's span."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(digest_batches(load(docs, model_file)), DIGEST)
