"""Removal of repeated passages by sorted suffixes.

Every byte that lies in a string of ``length`` bytes which also starts
earlier (in a row of a smaller doc_id, or further left) goes. Strings are
judged on the input; matches never cross rows.

Which suffixes can have an equal partner is found first, so that only those
are sorted:

1. Contexts. Of the grams of ``gram`` bytes in a window (a string of
   ``length`` bytes) the one of the smallest hash is its anchor. Equal windows
   have equal anchors, so windows are grouped by anchor; neighbouring windows
   of one anchor are a context. A task folds equal contexts of a chunk of
   texts: all but the first are repeated, whatever the rest of the table
   holds, so a passage of any number of copies sends one row a chunk.
2. The contexts left are dealt by anchor. Of equal ones (128 bits of hash) all
   but the first are repeated; an anchor of one context only is settled; the
   first of each kind of an anchor with several go on to be sorted.
3. Their bytes are cut out of the texts and dealt by anchor again. A task sorts
   the suffixes at all their windows, deep-shallow: multikey quicksort on
   words of eight bytes to a shallow depth, then a blind trie for each group
   that still agrees. A trie's leaf holds equal windows; all but the first of
   a leaf are repeated.
4. Repeated windows meet the texts again and are cut out.

Anchors of very many different contexts (a line that stands in a large share
of all texts) are nominated from a bounded sample; each of their windows is
an anchor of its own, by the hash of all its bytes, so that no task gets all
of them. The nomination decides how work is split, never what is found.

Defined results: a NULL text counts as empty; a NULL doc_id counts as larger
than any. Rows of one doc_id and different texts are ordered by a hash of
their texts; of rows that repeat both, one counts as first and the others as
repeated as a whole (from ``length`` bytes on). Very long texts are read in
slices. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corate.config import materialize
from corate.llm.common import BLOCK_BYTES, binary_texts, mix64, power_tables

LENGTH = 100
GRAM = 32
#: Bytes of text whose equal contexts a task folds at once.
CHUNK_BYTES = 8 << 20
#: Bytes of text whose windows are hashed at once.
SLICE_BYTES = 1 << 17
#: Bytes of contexts that a task sorts at once (or those of one anchor).
SORT_BYTES = 2 << 20
#: Depth in bytes at which blind tries take over from quicksort.
SHALLOW = 40
#: Rows (about) of the sample that nominates hot anchors, the different
#: contexts in it that make one hot, and how many are nominated at most.
HOT_ROWS, HOT_CONTEXTS, HOT_ANCHORS = 50_000, 25, 4096

#: A second value for each byte, so that two hashes of one string differ.
_SECOND = mix64(np.arange(1, 257, dtype=np.uint64))
_INDEX_BITS = 22
_CONTEXT_SCHEMA = "key long, kind long, k1 long, k2 long, place long"


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, k1, k2, text: (k1, k2) orders rows and tells them apart, but
    for rows that repeat both doc_id and text."""
    doc_id = F.col("doc_id").cast("long")
    text = F.coalesce("text", F.lit(""))
    return docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit((1 << 63) - 1)).alias("k1"),
                       F.xxhash64(text).alias("k2"), text.alias("text"))


# -- 1. contexts -------------------------------------------------------------

def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    done = 1
    out = values
    while 2 * done <= width:
        out = np.minimum(out[: len(out) - done], out[done:])
        done *= 2
    rest = width - done
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def slices(texts: list[bytes], length: int, limit: int = SLICE_BYTES) -> Iterator[list[tuple[int, int, bytes]]]:
    """Lists of (row, offset, bytes) of about ``limit`` bytes in which every
    window of every text lies whole, exactly once."""
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for row, text in enumerate(texts):
        for at in range(0, max(0, len(text) - length + 1), limit):
            part = text[at : at + limit + length - 1]
            if held and size + len(part) > limit:
                yield held
                held, size = [], 0
            held.append((row, at, part))
            size += len(part)
    if held:
        yield held


class Contexts:
    """Contexts of some slices as arrays: anchor hash, content hash, slice
    number, first window, number of windows, and the anchor's distance from
    the first window."""

    def __init__(self, parts: list[bytes], length: int, gram: int, hot: np.ndarray):
        data = np.frombuffer(b"".join(parts), np.uint8)
        size = np.array([len(p) for p in parts], np.int64)
        begin = np.cumsum(size) - size
        power, inverse = power_tables(len(data) + 1)

        def sums(values: np.ndarray) -> np.ndarray:
            out = np.zeros(len(values) + 1, np.uint64)
            np.cumsum(values * power[: len(values)], out=out[1:])
            return out

        def hashes(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
            return mix64((total[end] - total[start]) * inverse[start])

        with np.errstate(over="ignore"):
            one, two = sums(data.astype(np.uint64) + np.uint64(1)), sums(_SECOND[data])
            n_grams = len(data) - gram + 1
            grams = mix64((one[gram:] - one[:n_grams]) * inverse[:n_grams])
            low = np.uint64((1 << _INDEX_BITS) - 1)
            packed = (grams & ~low) | np.arange(n_grams, dtype=np.uint64)
            anchor = (sliding_min(packed, length - gram + 1) & low).astype(np.int64)
            # windows that lie in one slice; between two slices others stand
            inside = np.zeros(len(anchor) + 1, np.int8)
            np.add.at(inside, begin, 1)
            np.add.at(inside, begin + size - length + 1, -1)
            inside = np.cumsum(inside[:-1]).astype(bool)
            change = np.ones(len(anchor), bool)
            change[1:] = (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])
            first = np.flatnonzero(change)
            last = np.append(first[1:], len(anchor))
            real = inside[first]
            first, last = first[real], last[real]
            key, off = grams[anchor[first]], anchor[first] - first
            if len(hot) and (boiling := np.isin(key, hot)).any():
                # every window of a hot anchor is a context of its own
                n = (last - first)[boiling]
                each = np.repeat(first[boiling] - np.cumsum(n) + n, n) + np.arange(n.sum())
                first = np.concatenate((first[~boiling], each))
                last = np.concatenate((last[~boiling], each + 1))
                key = np.concatenate((key[~boiling], hashes(one, each, each + length)))
                off = np.concatenate((off[~boiling], np.zeros(len(each), np.int64)))
            self.n = last - first
            shape = (off * 256 + self.n).astype(np.uint64)
            self.key = key
            self.kind = mix64(hashes(two, first, last + length - 1) ^ (shape * np.uint64(0x9E3779B97F4A7C15)))
        self.off = off
        self.part = np.searchsorted(begin, first, side="right") - 1
        self.first = first - begin[self.part]


def _batch(columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def runs(*columns: np.ndarray) -> np.ndarray:
    """True where a row of sorted columns differs from the one before."""
    out = np.ones(len(columns[0]), bool)
    if len(out):
        out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return out


def covered(k1: np.ndarray, k2: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """The union of byte ranges per row, as (k1, k2, start, end)."""
    order = np.lexsort((end, start, k2, k1))
    k1, k2, start, end = k1[order], k2[order], start[order], end[order]
    if len(k1) == 0:
        return k1, k2, start, end
    new_row = runs(k1, k2)
    row = np.cumsum(new_row) - 1
    # running maximum of the ends, restarted at every row
    span = int(end.max()) + 1
    reach = np.maximum.accumulate(end + row * span) - row * span
    new = new_row.copy()
    new[1:] |= start[1:] > reach[:-1]
    first = np.flatnonzero(new)
    return k1[first], k2[first], start[first], reach[np.append(first[1:], len(k1)) - 1]


def find_contexts(length: int, gram: int, hot: list[int], chunk_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(k1, k2, text) rows to one row for each different context of a chunk:
    key, kind, k1, k2 and place (first window, windows, anchor distance). A
    range of bytes that is repeated for sure is a row with a negative place
    (-1 - start) and its end as kind, dealt by its row."""
    boiling = np.array(sorted(hot), np.int64).view(np.uint64)

    def fold(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        key, kind, k1, k2, place = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.lexsort((place, k2, k1, kind, key))
        key, kind, k1, k2, place = (c[order] for c in (key, kind, k1, k2, place))
        new = runs(key, kind)
        twin = ~runs(key, kind, k1, k2, place)
        yield from emit(key[new], kind[new], k1[new], k2[new], place[new])
        again = ~new & ~twin
        start = place[again] >> 16
        end = start + ((place[again] >> 8) & 255) + length - 1
        a, b, start, end = covered(k1[again], k2[again], start, end)
        with np.errstate(over="ignore"):
            yield from emit(mix64((a ^ b).view(np.uint64)).view(np.int64), end, a, b, -1 - start)

    def emit(*columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(columns[0]), 50_000):
            yield _batch([c[at : at + 50_000] for c in columns], ["key", "kind", "k1", "k2", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            k1, k2 = (batch.column(i).to_numpy() for i in (0, 1))
            for parts in slices(binary_texts(batch.column(2)), length):
                c = Contexts([p for _, _, p in parts], length, gram, boiling)
                row = np.array([r for r, _, _ in parts])[c.part]
                at = np.array([a for _, a, _ in parts])[c.part] + c.first
                held.append((c.key.view(np.int64), c.kind.view(np.int64), k1[row], k2[row], (at << 16) | (c.n << 8) | c.off))
                size += sum(len(p) for _, _, p in parts)
                if size > chunk_bytes:
                    yield from fold(held)
                    held, size = [], 0
        if held:
            yield from fold(held)
    return run


def hot_anchors(rows: DataFrame, length: int, gram: int, sample_rows: int, least: int) -> list[int]:
    """Anchors of many different contexts in a sample of rows by hash."""
    share = min(1.0, sample_rows / max(1, rows.select("k1").count()))
    chosen = F.shiftrightunsigned(F.xxhash64("k1", "k2"), 32) < int(share * (1 << 32))
    sample = rows.select("k1", "k2", "text").where(chosen)
    found = sample.mapInArrow(find_contexts(length, gram, [], CHUNK_BYTES), _CONTEXT_SCHEMA).where("place >= 0")
    kinds = found.select("key", "kind").distinct().groupBy("key").count()
    return [r.key for r in kinds.where(F.col("count") >= least).orderBy(F.desc("count"), "key").limit(HOT_ANCHORS).select("key").collect()]


# -- 2. equal contexts -------------------------------------------------------

_SETTLED = "k1 long, k2 long, start long, end long, key long, off long"


def settle(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Contexts sorted by key, kind, k1, k2 and place: repeated ranges of bytes
    (off is NULL), and the contexts that are still to be compared. What goes
    from batch to batch is the last row and one context."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, pending, several = None, None, False
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = np.stack([batch.column(i).to_numpy() for i in range(5)])
            known = rows[:, rows[4] < 0]
            rows = rows[:, rows[4] >= 0]
            out = [(known[2], known[3], -1 - known[4], known[1], np.zeros(len(known[0]), np.int64), np.full(len(known[0]), -1))]
            if rows.shape[1]:
                joined = rows if before is None else np.concatenate((before, rows), axis=1)
                skip = 0 if before is None else 1
                new_key = runs(joined[0])[skip:]
                new_kind = runs(joined[0], joined[1])[skip:]
                twin = ~runs(*joined)[skip:]
                out.append(ranges(rows[:, ~new_kind & ~twin], marks=True))
                first = rows[:, new_kind]
                # contexts of a key that has several; the key of the first
                # rows may have begun in an earlier batch
                number = np.cumsum(new_key[new_kind])
                per_key = np.bincount(number, minlength=number[-1] + 1 if len(number) else 1)
                if per_key[0] and (pending is not None or several):
                    if pending is not None:
                        out.append(ranges(pending, marks=False))
                    pending, several = None, True
                many = per_key >= 2
                many[0] = many[0] or several
                out.append(ranges(first[:, many[number]], marks=False))
                if new_key.any():
                    several = bool(per_key[-1] >= 2)
                    pending = None if several else first[:, -1:]
                before = rows[:, -1:]
            columns = [np.concatenate(c) for c in zip(*out, strict=True)]
            if len(columns[0]):
                off = pa.array(columns[5].astype(np.int64), mask=columns[5] < 0)
                yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns[:5]), off], ["k1", "k2", "start", "end", "key", "off"])

    def ranges(rows: np.ndarray, marks: bool) -> tuple[np.ndarray, ...]:
        start = rows[4] >> 16
        end = start + ((rows[4] >> 8) & 255) + length - 1
        if marks:
            return rows[2], rows[3], start, end, np.zeros(len(start), np.int64), np.full(len(start), -1)
        return rows[2], rows[3], start, end, rows[0], rows[4] & 255
    return run


# -- 3. deep-shallow sorting -------------------------------------------------

def words_at(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes at each place as one number in their order."""
    return data[at[:, None] + np.arange(8)].view(">u8")[:, 0].astype(np.uint64)


def multikey_quicksort(data: np.ndarray, starts: np.ndarray, bucket: np.ndarray, shallow: int) -> list[np.ndarray]:
    """Groups of two or more suffixes that agree in bucket and in their first
    ``shallow`` bytes.

    All buckets are partitioned at once, level by level: every part takes a
    pivot word and splits in less, equal and greater; the equal part goes on
    to the next word."""
    order = np.argsort(bucket, kind="stable")
    part = np.cumsum(runs(bucket[order])) - 1
    depth = np.zeros(part[-1] + 1 if len(part) else 0, np.int64)
    ready: list[np.ndarray] = []
    while len(order):
        size = np.bincount(part, minlength=len(depth))
        # a part of one is sorted; a part that agrees deep enough is a group
        deep = (depth >= shallow) & (size >= 2)
        if deep.any():
            taken = deep[part]
            ready += np.split(order[taken], np.cumsum(size[deep])[:-1])
        open_part = (size >= 2) & ~deep
        alive = open_part[part]
        order, part = order[alive], part[alive]
        if len(order) == 0:
            break
        number = np.cumsum(open_part) - 1
        part, depth, size = number[part], depth[open_part], size[open_part]
        key = words_at(data, starts[order] + depth[part])
        begin = np.cumsum(size) - size
        ends = np.stack((key[begin], key[begin + size // 2], key[begin + size - 1]))
        pivot = np.sort(ends, axis=0)[1][part]
        side = np.where(key < pivot, 0, np.where(key == pivot, 1, 2))
        moved = np.argsort(3 * part + side, kind="stable")
        order, code = order[moved], (3 * part + side)[moved]
        new = runs(code)
        depth = depth[code[new] // 3] + 8 * (code[new] % 3 == 1)
        part = np.cumsum(new) - 1
    return ready


class BlindTrie:
    """Patricia trie of strings of one length: inner nodes know the depth at
    which their strings part, and the byte there; what lies between is not
    kept but compared once, with the leaf that a blind descent ends in."""

    def __init__(self, data: bytes, length: int):
        self.data, self.length = data, length
        self.root: list | None = None

    def add(self, start: int, label: int) -> None:
        """Inner nodes are [depth, {byte: node}], leaves [None, start, labels]."""
        data = self.data
        if self.root is None:
            self.root = [None, start, [label]]
            return
        node = self.root
        while node[0] is not None:
            node = node[1].get(data[start + node[0]]) or next(iter(node[1].values()))
        other = node[1]
        own = data[start : start + self.length]
        common = self.agreement(own, data[other : other + self.length])
        if common == self.length:
            node[2].append(label)
            return
        above, node = None, self.root
        while node[0] is not None and node[0] < common:
            above, node = node, node[1][own[node[0]]]
        leaf = [None, start, [label]]
        if node[0] == common:
            node[1][own[common]] = leaf
            return
        fork = [common, {data[other + common]: node, own[common]: leaf}]
        if above is None:
            self.root = fork
        else:
            above[1][own[above[0]]] = fork

    def agreement(self, a: bytes, b: bytes) -> int:
        """Length of the common prefix of two strings of the trie's length."""
        if a == b:
            return self.length
        differ = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
        return self.length - (differ.bit_length() + 7) // 8

    def leaves(self) -> Iterator[list[int]]:
        """Labels of equal strings, strings in ascending order."""
        stack = [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if node[0] is None:
                yield node[2]
            else:
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]


def equal_suffixes(data: bytes, starts: np.ndarray, bucket: np.ndarray, length: int, shallow: int = SHALLOW) -> Iterator[list[int]]:
    """Numbers of the suffixes whose first ``length`` bytes are equal, in lists
    of two or more; suffixes of different buckets are known to differ.
    ``starts`` must leave eight bytes beyond ``length`` in ``data``."""
    for group in multikey_quicksort(np.frombuffer(data, np.uint8), starts, bucket, min(shallow, length // 8 * 8)):
        trie = BlindTrie(data, length)
        for i in group.tolist():
            trie.add(int(starts[i]), i)
        yield from (labels for labels in trie.leaves() if len(labels) > 1)


def sort_contexts(length: int, sort_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Contexts sorted by key, with their bytes, to ranges of repeated bytes."""
    def repeated(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        data = b"".join(h[5] for h in held) + bytes(8)
        key, k1, k2, start, off = (np.array([h[i] for h in held], np.int64) for i in range(5))
        size = np.array([len(h[5]) for h in held], np.int64)
        n = size - length + 1
        context = np.repeat(np.arange(len(held)), n)
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        places = np.repeat(np.cumsum(size) - size, n) + step
        # equal windows hold their anchor at one distance
        bucket = (np.cumsum(runs(key)) - 1)[context] * 256 + off[context] - step
        own = (k1[context], k2[context], start[context] + step)
        again: list[int] = []
        for labels in equal_suffixes(data, places, bucket, length):
            first = min(labels, key=lambda i: (own[0][i], own[1][i], own[2][i]))
            again += [i for i in labels if i != first]
        if again:
            a, b, s = (c[again] for c in own)
            yield _batch(list(covered(a, b, s, s + length)), ["k1", "k2", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size > sort_bytes and row[0] != held[-1][0]:
                    yield from repeated(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
        if held:
            yield from repeated(held)
    return run


def cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k1, k2, packed text, wanted contexts) to the contexts' bytes."""
    unpack = zstandard.ZstdDecompressor().decompress
    names = ["key", "k1", "k2", "start", "off", "content"]
    for batch in batches:
        rows, size = [], 0
        for k1, k2, packed, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            text = unpack(packed)
            for w in wanted:
                rows.append((w["key"], k1, k2, w["start"], w["off"], text[w["start"] : w["end"]]))
                size += w["end"] - w["start"]
                if size > BLOCK_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)


# -- 4. what stays -----------------------------------------------------------

def packed_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one, as they cross the network."""
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        packed = [pack(t) for t in binary_texts(batch.column(3))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(packed, pa.binary())], ["doc_id", "k1", "k2", "packed"])


REMOVED_SCHEMA = "doc_id long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary"


def remove_ranges(length: int, digest: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(doc_id, packed text, whether it is a row's repetition, repeated
    ranges) to the removed runs and the bytes left (or their digest)."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def one(text: bytes, repetition: bool, marks: list | None) -> tuple[list[dict], bytes]:
        if repetition:
            marks = [{"start": 0, "end": len(text)}] if len(text) >= length else []
        runs_, at, kept = [], 0, []
        for m in sorted(marks or [], key=lambda m: m["start"]):
            if runs_ and m["start"] <= runs_[-1]["end"]:
                runs_[-1]["end"] = max(runs_[-1]["end"], m["end"])
            else:
                runs_.append(dict(m))
        for r in runs_:
            kept.append(text[at : r["start"]])
            at = r["end"]
        return runs_, b"".join([*kept, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            ids, n_bytes, removed, left = batch.column(0), [], [], []
            for packed, repetition, marks in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                text = unpack(packed)
                r, kept = one(text, repetition, marks)
                n_bytes.append(len(text))
                removed.append(r)
                left.append(hashlib.sha256(kept).digest() if digest else kept)
            yield pa.RecordBatch.from_arrays([ids, pa.array(n_bytes, pa.int64()), pa.array(removed, span), pa.array(left, pa.binary())], ["doc_id", "n_bytes", "removed", "kept"])
    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, digest: bool = False,
                   chunk_bytes: int = CHUNK_BYTES, sort_bytes: int = SORT_BYTES,
                   hot_rows: int = HOT_ROWS, hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """Every row's doc_id, n_bytes, removed runs of bytes (start, end) and
    the bytes kept (their SHA-256 with ``digest``). ``docs`` needs doc_id and
    text. ``gram`` must be less than ``length``, ``length`` at most 200."""
    if not 8 <= gram < length <= 200:
        raise ValueError("needs 8 <= gram < length <= 200")
    rows = keyed(docs)
    hot = hot_anchors(rows, length, gram, hot_rows, hot_contexts)
    contexts = rows.select("k1", "k2", "text").mapInArrow(find_contexts(length, gram, hot, chunk_bytes), _CONTEXT_SCHEMA)
    sorted_contexts = contexts.repartition("key").sortWithinPartitions("key", "kind", "k1", "k2", "place")
    settled = materialize(sorted_contexts.mapInArrow(settle(length), _SETTLED), "contexts")

    # both joins read the texts from one exchange
    by = Window.partitionBy("k1", "k2").orderBy("k1")
    texts = rows.mapInArrow(packed_texts, "doc_id long, k1 long, k2 long, packed binary").withColumn("nth", F.row_number().over(by))
    wanted = settled.where("off IS NOT NULL").groupBy("k1", "k2").agg(F.collect_list(F.struct("key", "start", "end", "off")).alias("wanted"))
    cut = texts.where("nth = 1").join(wanted, ["k1", "k2"]).select("k1", "k2", "packed", "wanted").mapInArrow(
        cut_contexts, "key long, k1 long, k2 long, start long, off long, content binary")
    compared = cut.repartition("key").sortWithinPartitions("key").mapInArrow(sort_contexts(length, sort_bytes), "k1 long, k2 long, start long, end long")
    known = settled.where("off IS NULL").select("k1", "k2", "start", "end")
    marks = known.unionByName(compared).groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "end")).alias("marks"))
    final = texts.join(marks, ["k1", "k2"], "left").select("doc_id", "packed", (F.col("nth") > 1).alias("repetition"), "marks")
    return final.mapInArrow(remove_ranges(length, digest), REMOVED_SCHEMA)


def repeat_digest(removed: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of ``remove_repeats``
    with ``digest``."""
    sizes = F.aggregate("removed", F.lit(0).cast("long"), lambda total, r: total + r["end"] - r["start"])
    return removed.select("doc_id", "n_bytes", sizes.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
                          F.lower(F.hex("kept")).alias("kept_sha256"))
