"""Exact n-gram Jaccard join with set-relation skipping.

A document is the set of its word shingles' 64-bit hashes. Equal sets are
one set: sets are told apart by 128 bits, of which 64 are their id (see
``SetIds``). The index has, for every set, only its prefix in a global order
(rarest first, by a corpus-wide count sketch): two sets that link share a
token there.

Skipping, in the order in which it is used:

* Positions. Of two sets that link the smaller one holds a common token in a
  still shorter prefix (``index_length``), so only the entries of these
  positions are index lists; all others only ask. Lists lie in blocks of
  sizes, and an entry asks the blocks whose sizes its position leaves
  reachable. What a template of a hundred thousand pages shares stands behind
  each page's own rare tokens, in positions that no block has: the lists of
  such tokens are empty and are skipped whole. Within a block, entry pairs
  whose positions rule a link out are dropped by the condition of the join.
* Answers of similar sets. Sets of a token are first compared with the
  token's pivot. A set that links to its pivot joins the pivot's cluster, and
  its few differences from the pivot are kept. Jaccard distance is a metric,
  so two clusters whose pivots are further apart than the threshold and both
  radii hold no link, and pivots that link connect all members. What lies
  between is settled member by member, each answer derived incrementally: the
  overlap of a member with a set is its pivot's overlap with that set, less
  what the member lacks of it and more what it adds. Neither a member's
  complete set nor its text is read again.
* Components. Pairs that links already connect are not compared.
* Bitmaps. A set's parity bitmap bounds the symmetric difference from
  below; only pairs that pass have their complete sets intersected.

A hot group of near copies thus costs one comparison a member, and all
index work is per (token, cluster). Nothing is capped: what a bound cannot
decide is compared exactly.

Defined results: NULL, empty or wordless text has an empty set (n_shingles
0), is linked with nothing and its component is its own doc_id; with fewer
words than a shingle, the whole sequence is the one shingle; equal rows
share a component; a NULL doc_id is never the smallest unless all are NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corate.config import materialize
from corate.llm.common import BLANKS, Words, binary_texts, blocks, byte_table, fresh_name, mix64
from corate.llm.components import components
from corate.operators.blocks import join_split

WORD = byte_table(BLANKS)
#: Counters of the frequency sketch, and counters of one of its rows.
SKETCH_BITS = 20
SKETCH_ROW = 1 << 14
#: Sets that a task remembers so as not to index copies again.
SEEN_SETS = 200_000
#: Pivots that a set is compared with before clusters are formed.
PIVOTS = 2


class ShingleSets:
    """Distinct shingle hashes of each text of a block, in rising order."""

    def __init__(self, texts: list[bytes], k: int):
        words = Words([t.lower() for t in texts], WORD)
        grams, at = words.grams(k)
        row = np.repeat(np.arange(len(texts)), words.count)[at]
        short = np.flatnonzero((words.count > 0) & (words.count < k))
        if len(short):
            whole = [words.window(int(words.first[r]), int(words.count[r])) for r in short]
            grams, row = np.concatenate((grams, np.array(whole, np.uint64))), np.concatenate((row, short))
        order = np.lexsort((grams, row))
        grams, row = grams[order], row[order]
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
        self.hash, self.row = grams[new], row[new]
        self.bounds = np.searchsorted(self.row, np.arange(len(texts) + 1))
        self.size = np.diff(self.bounds)

    def ids(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit ids of each set, 128 bits together; equal sets have
        equal ids."""
        with np.errstate(over="ignore"):
            totals = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix64(self.hash ^ np.uint64(s)), dtype=np.uint64))) for s in (0x51A3, 0xC0FFEE)]
            a, b = (t[self.bounds[1:]] - t[self.bounds[:-1]] for t in totals)
            n = self.size.astype(np.uint64)
            first = mix64(mix64(a) + b * np.uint64(0x9E3779B97F4A7C15) + n)
            second = mix64(mix64(b) + a * np.uint64(0xA0761D6478BD642F) + n)
            return first.view(np.int64), second.view(np.int64)

    def of(self, r: int) -> np.ndarray:
        return self.hash[self.bounds[r] : self.bounds[r + 1]]


class SetIds(NamedTuple):
    """The id of a set: the first of its two, or the second where different
    sets have the same first one (``shared``: of n sets n^2 / 2^65 are
    expected, about three of 10^10). ``bits`` are those kept of the first."""

    bits: int = 64
    shared: np.ndarray = np.zeros(0, np.int64)

    def both(self, sets: ShingleSets) -> tuple[np.ndarray, np.ndarray]:
        first, second = sets.ids()
        cut = 64 - self.bits
        return (first >> cut) << cut, second

    def of(self, sets: ShingleSets) -> np.ndarray:
        first, second = self.both(sets)
        return np.where(np.isin(first, self.shared), second, first) if len(self.shared) else first


def parity_bitmap(hashes: np.ndarray) -> bytes:
    """Parity of the set's hashes in at least twice as many bits as hashes.
    Folding the halves of a bitmap together gives the bitmap of half size."""
    bits = max(64, 1 << int(2 * len(hashes) - 1).bit_length())
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def short_bitmap(hashes: np.ndarray) -> np.ndarray:
    """The parity bitmap of 1024 bits as 16 longs, for join conditions."""
    odd = np.bincount((hashes & np.uint64(1023)).astype(np.int64), minlength=1024) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound of the symmetric difference of two sets."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


# --- passes over the texts -------------------------------------------------

SET_ROWS = "doc_id long, n long, sid long, second long, part int, counts binary"


def set_rows(names: SetIds, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Size and both ids of every row's set, then the task's count sketch: how
    many sets hold a token of each bucket, in parts of SKETCH_ROW buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.int32)
        for batch in batches:
            texts = binary_texts(batch.column(1))
            for a, b in blocks(texts):
                sets = ShingleSets(texts[a:b], k)
                counts = np.bincount((sets.hash >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=1 << SKETCH_BITS)
                np.add(sketch, counts, out=sketch, casting="unsafe")
                ids = [pa.array(x, mask=sets.size == 0) for x in names.both(sets)]
                yield _batch(SET_ROWS, [batch.column(0).slice(a, b - a), sets.size, *ids, [None] * (b - a), [None] * (b - a)])
        parts = [(p, sketch[p * SKETCH_ROW : (p + 1) * SKETCH_ROW]) for p in range((1 << SKETCH_BITS) // SKETCH_ROW)]
        parts = [(p, c.tobytes()) for p, c in parts if c.any()]
        yield _batch(SET_ROWS, [[None] * len(parts)] * 4 + [[p for p, _ in parts], [c for _, c in parts]])
    return run


_TYPES = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "boolean": pa.bool_()}


def _batch(schema: str, columns: list) -> pa.RecordBatch:
    """A batch of a schema given as DDL of simple fields."""
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) and c.type == _TYPES[t] else pa.array(c, _TYPES[t]) for c, (_, t) in zip(columns, fields, strict=True)],
        [n for n, _ in fields])


def sum_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the parts of all tasks, one running sum a part."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            c = np.frombuffer(counts, np.int32)
            total[part] = total[part] + c if part in total else c.astype(np.int64)
    yield _batch("part int, counts binary", [list(total), [v.astype(np.int64).tobytes() for v in total.values()]])


def frequency_classes(sketch: np.ndarray) -> np.ndarray:
    """A class of each bucket: 0 for counts that the mean load explains,
    then by powers of two of the excess over its deviation."""
    mean = float(sketch.mean())
    excess = (sketch - mean) / (3 * np.sqrt(mean) + 1)
    return np.maximum(0, np.floor(np.log2(np.maximum(excess, 0.5))) + 1).astype(np.uint8)


def prefix_length(n: int, percent: int) -> int:
    """Tokens of a set of n of which a linking set holds one at least."""
    return n - -(-percent * n // 100) + 1


def index_length(n: Column, percent: int) -> Column:
    """Tokens of a set of n of which any linking set of n tokens or more holds
    one at least: the two share 2 percent / (100 + percent) of n."""
    return n - F.ceil(n * (2 * percent) / (100 + percent) - 1e-9).cast("long") + 1


def size_block(n: Column, percent: int) -> Column:
    """Blocks of sizes, as wide as a set may be larger than one that it links
    with: a set's smaller partners lie in its own block and the one below."""
    return F.floor(F.log(n.cast("double")) / np.log(100 / percent) + 1e-9).cast("int")


INDEX = "sid long, n long, tokens array<long>, bitmap binary, bits array<long>"


def index_rows(classes, names: SetIds, k: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Prefix and bitmap of each distinct set of the task (a set that many
    tasks hold comes once a task)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = classes.value, set()
        for batch in batches:
            texts = binary_texts(batch.column(1))
            for a, b in blocks(texts):
                sets, rows = ShingleSets(texts[a:b], k), []
                kind = table[(sets.hash >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                for r, sid in enumerate(names.of(sets).tolist()):
                    n = int(sets.size[r])
                    if not n or sid in seen:
                        continue
                    if len(seen) < SEEN_SETS:
                        seen.add(sid)
                    hashes, c = sets.of(r), kind[sets.bounds[r] : sets.bounds[r + 1]]
                    # hashes are sorted, so a stable sort by class orders by both
                    prefix = hashes[np.argsort(c, kind="stable")[: prefix_length(n, percent)]]
                    rows.append((sid, n, prefix.view(np.int64), parity_bitmap(hashes), short_bitmap(hashes)))
                yield _batch(INDEX, list(zip(*rows, strict=True)) if rows else [[]] * 5)
    return run


def pack_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, bit) rows to one bitmap of 8192 bits a part."""
    parts: dict[int, np.ndarray] = {}
    for batch in batches:
        part, bit = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(2))
        for p in np.unique(part).tolist():
            parts.setdefault(p, np.zeros(8192, bool))[bit[part == p]] = True
    yield _batch("part long, bits binary", [list(parts), [np.packbits(v).tobytes() for v in parts.values()]])


def wanted_filter(sids: DataFrame) -> tuple[int, np.ndarray]:
    """Bits that are set for the given set ids: 16 a set, 2^26 at most (8
    MB). It only drops sets without a partner; others may pass."""
    bits = min(26, max(13, (16 * sids.count()).bit_length()))
    position = F.shiftrightunsigned("sid", 64 - bits)
    rows = sids.select((position / 8192).cast("long").alias("part"), (position % 8192).alias("bit"))
    table = np.zeros((1 << bits) // 8, np.uint8)
    for r in rows.repartition("part").mapInArrow(pack_bits, "part long, bits binary").collect():
        table[r.part * 1024 : (r.part + 1) * 1024] = np.frombuffer(r.bits, np.uint8)
    return bits, table


SETS = "sid long, hashes binary"


def complete_sets(wanted, names: SetIds, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Complete hashes of the wanted sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, table = wanted.value
        seen: set[int] = set()
        for batch in batches:
            texts = binary_texts(batch.column(1))
            for a, b in blocks(texts):
                sets, rows = ShingleSets(texts[a:b], k), []
                ids = names.of(sets)
                at = ids.view(np.uint64) >> np.uint64(64 - bits)
                hit = (table[(at >> np.uint64(3)).astype(np.int64)] >> (7 - (at & np.uint64(7)).astype(np.uint8))) & 1
                for r in np.flatnonzero(hit.astype(bool) & (sets.size > 0)):
                    sid = int(ids[r])
                    if sid not in seen:
                        if len(seen) < SEEN_SETS:
                            seen.add(sid)
                        rows.append((sid, sets.of(r).tobytes()))
                if rows:
                    yield _batch(SETS, list(zip(*rows, strict=True)))
    return run


# --- comparing pairs -------------------------------------------------------

PASSED = "a long, b long"


def passes_bitmap(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pairs (a, b, na, nb, slack, bitmap_a, bitmap_b) whose similarity may
    reach percent minus slack."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for na, nb, slack, x, y in zip(*(batch.column(i).to_pylist() for i in range(2, 7)), strict=True):
                d = least_difference(x, y)
                keep.append(100 * (na + nb - d) >= (percent - 100 * slack - 1e-6) * (na + nb + d))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


VERIFIED = "a long, b long, common long, total long"
DIFFERENT = "lost binary, gained binary"


def hashes_of(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, np.uint64)


def held(tokens: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which tokens a complete set (rising hashes) holds."""
    at = np.searchsorted(hashes, tokens)
    return (at < len(hashes)) & (hashes[np.minimum(at, len(hashes) - 1)] == tokens) if len(hashes) else np.zeros(len(tokens), bool)


def intersect(percent: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sizes of intersection and union of pairs (a, b, hashes_a, hashes_b);
    with ``percent`` only of pairs that link, and what a lacks of b and has
    beyond it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for a, b, x, y in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                u, v = hashes_of(x), hashes_of(y)
                shared = held(u, v)
                common = int(shared.sum())
                total = len(u) + len(v) - common
                if percent is None:
                    rows.append((a, b, common, total))
                elif 100 * common >= percent * total:
                    rows.append((a, b, common, total, v[~held(v, u)].tobytes(), u[~shared].tobytes()))
            schema = VERIFIED if percent is None else f"{VERIFIED}, {DIFFERENT}"
            yield _batch(schema, list(zip(*rows, strict=True)) if rows else [[]] * len(schema.split(",")))
    return run


def derive_from_pivot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answers of members x (x, b, pivots' common, lost, gained, n_x, hashes
    of b): the overlap of x with b from that of its pivot with b."""
    for batch in batches:
        rows = []
        for x, b, common, lost, gained, n, packed in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
            other = hashes_of(packed)
            common += int(held(hashes_of(gained), other).sum()) - int(held(hashes_of(lost), other).sum())
            rows.append((x, b, common, n + len(other) - common))
        yield _batch(VERIFIED, list(zip(*rows, strict=True)) if rows else [[]] * 4)


def derive_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answers of pairs of members x and y: the overlap of x with y from that
    of x with y's pivot, known already; x itself is its pivot's set with x's
    differences."""
    for batch in batches:
        rows = []
        for x, y, common, lost_x, gained_x, lost_y, gained_y, n_x, n_y, packed in zip(*(batch.column(i).to_pylist() for i in range(10)), strict=True):
            pivot, lost, gained = hashes_of(packed), hashes_of(lost_x), hashes_of(gained_x)

            def of_x(tokens: np.ndarray) -> int:
                return int(((held(tokens, pivot) & ~held(tokens, lost)) | held(tokens, gained)).sum())

            common += of_x(hashes_of(gained_y)) - of_x(hashes_of(lost_y))
            rows.append((x, y, common, n_x + n_y - common))
        yield _batch(VERIFIED, list(zip(*rows, strict=True)) if rows else [[]] * 4)


class JaccardJoin:
    """The join over one table; each step's table is kept in scratch."""

    def __init__(self, docs: DataFrame, words: int, percent: int, id_bits: int = 64):
        self.spark = docs.sparkSession
        self.k, self.percent = words, percent
        self.texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        rows = materialize(self.texts.mapInArrow(set_rows(SetIds(id_bits), words), SET_ROWS), "sets")
        self.names = SetIds(id_bits, self._shared_ids(rows))
        sid = F.col("sid")
        if len(self.names.shared):
            sid = F.when(sid.isin(self.names.shared.tolist()), F.col("second")).otherwise(sid)
        self.rows = rows.where("part is null").select("doc_id", "n", sid.alias("sid"))
        sketch = np.zeros(1 << SKETCH_BITS, np.int64)
        parts = rows.where("part is not null").select("part", "counts")
        for r in parts.repartition("part").mapInArrow(sum_sketches, "part int, counts binary").collect():
            sketch[r.part * SKETCH_ROW : (r.part + 1) * SKETCH_ROW] = np.frombuffer(r.counts, np.int64)
        classes = self.spark.sparkContext.broadcast(frequency_classes(sketch))  # one byte a bucket
        index = materialize(self.texts.mapInArrow(index_rows(classes, self.names, words, percent), INDEX), "index")
        # written, so that AQE can split a join with them by a hot pivot: it does
        # so where both sides are read as they were dealt, not above an aggregate
        self.bitmaps = materialize(index.groupBy("sid").agg(F.first("n").alias("n"), F.first("bitmap").alias("bitmap")), "bitmaps")
        self.bits = index.groupBy("sid").agg(F.first("n").alias("n"), F.first("bits").alias("bits"))
        entries = index.select("sid", "n", F.posexplode("tokens").alias("position", "token"))
        shared = entries.groupBy("token").agg(F.min("sid").alias("a"), F.max("sid").alias("b")).where("a < b").select("token")
        shared = materialize(entries.join(shared, "token").groupBy("token", "sid").agg(F.first("n").alias("n"), F.first("position").alias("position")), "shared")
        self.entries = materialize(self._with_pivots(shared), "entries")

    @staticmethod
    def _shared_ids(rows: DataFrame) -> np.ndarray:
        """First ids that different sets have, by chance alone (``SetIds``)."""
        seconds = rows.where("n > 0").groupBy("sid").agg(F.min("second").alias("least"), F.max("second").alias("most"))
        return np.array(sorted(r.sid for r in seconds.where("least < most").select("sid").collect()), np.int64)

    def _with_pivots(self, shared: DataFrame) -> DataFrame:
        """Entries with their token's pivot: the set of which the largest
        share of prefix tokens is shared. The text that others are edited
        copies of shares all of its tokens; its copies have some of their
        own, and are nearer to it than to each other."""
        prefix = F.col("n") - F.ceil(F.col("n") * self.percent / 100) + 1
        share = shared.groupBy("sid").agg((F.count("*") / F.first(prefix)).alias("share"))
        ranked = shared.join(share, "sid")
        pivots = ranked.groupBy("token").agg(F.min(F.struct((-F.col("share")).alias("share"), "sid")).alias("p"))
        return ranked.join(pivots.select("token", F.col("p.sid").alias("pivot")), "token").select("token", "sid", "n", "position", "pivot")

    def reach(self, na: Column, nb: Column) -> Column:
        """Overlap times (100 + percent) that sets of these sizes need."""
        return self.percent * (na + nb)

    def sizes_fit(self, na: Column, nb: Column) -> Column:
        return F.least(na, nb) * 100 >= F.greatest(na, nb) * self.percent

    def may_link(self, a: str, b: str, slack: Column) -> Column:
        """Whether the short bitmaps leave two sets (columns n and bits with
        the suffixes) a similarity of percent minus slack; for the condition
        of a join, so that other pairs are never made."""
        d = F.aggregate(F.zip_with(f"bits_{a}", f"bits_{b}", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
        both = F.col(f"n_{a}") + F.col(f"n_{b}")
        return 100 * (both - d) >= (self.percent - 100 * slack - 1e-6) * (both + d)

    def verify(self, pairs: DataFrame, slack: Column | float = 0.0, differences: bool = False) -> tuple[DataFrame, DataFrame]:
        """Exact intersection and union of the pairs (a, b and, if slack
        needs them, more columns) whose similarity may reach percent minus
        slack, and the complete sets of those pairs; with ``differences`` the
        pairs that link, and in what they differ."""
        pairs = pairs.withColumn("slack", slack if isinstance(slack, Column) else F.lit(slack)).select("a", "b", "slack")
        left, right = (self.bitmaps.select(F.col("sid").alias(s), F.col("n").alias(f"n{s}"), F.col("bitmap").alias(f"bitmap_{s}")) for s in "ab")
        bounded = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "slack", "bitmap_a", "bitmap_b")
        passed = materialize(bounded.mapInArrow(passes_bitmap(self.percent), PASSED), "passed")
        sids = passed.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
        wanted = self.spark.sparkContext.broadcast(wanted_filter(sids))
        sets = (self.texts.mapInArrow(complete_sets(wanted, self.names, self.k), SETS).join(sids, "sid", "left_semi")
                .groupBy("sid").agg(F.first("hashes").alias("hashes")))
        sets = materialize(sets, "complete")
        left, right = (sets.select(F.col("sid").alias(s), F.col("hashes").alias(f"hashes_{s}")) for s in "ab")
        both = passed.join(left, "a").join(right, "b").select("a", "b", "hashes_a", "hashes_b")
        if differences:
            return materialize(both.mapInArrow(intersect(self.percent), f"{VERIFIED}, {DIFFERENT}"), "verified"), sets
        return materialize(both.mapInArrow(intersect(None), VERIFIED), "verified"), sets

    def linked(self) -> Column:
        return F.col("common") * 100 >= F.col("total") * self.percent

    def pivot_links(self) -> DataFrame:
        """Links between sets and pivots of their tokens (a the set, b the
        pivot): the pivots that share most of its tokens are compared."""
        sizes = self.entries.select(F.col("sid").alias("pivot"), F.col("n").alias("pivot_n")).distinct()
        votes = self.entries.where("sid <> pivot").groupBy("sid", "pivot").agg(F.first("n").alias("n"), F.count("*").alias("votes"))
        fit = votes.join(sizes, "pivot").where(self.sizes_fit(F.col("n"), F.col("pivot_n")))
        by = Window.partitionBy("sid").orderBy(F.desc("votes"), "pivot")
        pairs = fit.withColumn("r", F.row_number().over(by)).where(F.col("r") <= PIVOTS).select(F.col("sid").alias("a"), F.col("pivot").alias("b"))
        return self.verify(pairs, differences=True)[0]

    def links(self) -> DataFrame:
        """Links (a, b) of sets that connect all that link: a spanning part
        of the links, enough for components."""
        star = self.pivot_links()
        best = star.groupBy("a").agg(F.max(F.struct((F.col("common") / F.col("total")).alias("similarity"), "b")).alias("m"))
        member = best.select(F.col("a").alias("sid"), F.col("m.b").alias("cluster"), (1 - F.col("m.similarity")).alias("distance"))
        centers = member.select(F.col("cluster").alias("sid")).distinct()
        # a pivot that others chose stays the centre of its own cluster
        differences = star.select(F.col("a").alias("sid"), F.col("b").alias("cluster"), "lost", "gained")
        member = materialize(member.join(centers, "sid", "left_anti").join(differences, ["sid", "cluster"]), "members")
        entries = self.entries.join(member.select("sid", "cluster", "distance"), "sid", "left").withColumns({"cluster": F.coalesce("cluster", "sid"), "distance": F.coalesce("distance", F.lit(0.0))})
        entries = materialize(entries.withColumn("block", size_block(F.col("n"), self.percent)), "lists")
        pairs = materialize(self._cluster_pairs(entries), "cluster-pairs")
        radius = materialize(member.groupBy("cluster").agg(F.max("distance").alias("radius")), "radius")
        loose = self._with_radii(pairs, radius).withColumn("slack", F.col("ra") + F.col("rb"))
        loose = materialize(loose, "loose")
        compared, pivot_sets = self.verify(loose, F.col("slack"))
        found = star.select("a", "b").unionByName(compared.where(self.linked()).select("a", "b"))
        found = materialize(found.distinct(), "links")
        between = compared.where(~self.linked()).join(loose, ["a", "b"]).withColumn("apart", self.apart())
        between = materialize(between.where((F.col("slack") > 0) & (F.col("apart") <= self.farthest() + F.col("slack"))).select("a", "b", "apart", "ra", "rb", "common"), "between")
        if between.isEmpty():
            return found
        return found.unionByName(self._member_links(between, found, member, pivot_sets))

    def apart(self) -> Column:
        """Jaccard distance of a compared pair."""
        return 1 - F.col("common") / F.col("total")

    def farthest(self) -> float:
        """The distance up to which sets link, and a little for rounding."""
        return 1 - self.percent / 100 + 1e-9

    def _with_radii(self, pairs: DataFrame, radius: DataFrame) -> DataFrame:
        """Pairs of clusters with the largest distance of a member from each
        pivot (0 for a set by itself)."""
        ra, rb = (radius.select(F.col("cluster").alias(s), F.col("radius").alias(f"r{s}")) for s in "ab")
        return pairs.join(ra, "a", "left").join(rb, "b", "left").select("a", "b", F.coalesce("ra", F.lit(0.0)).alias("ra"), F.coalesce("rb", F.lit(0.0)).alias("rb"))

    def _cluster_pairs(self, entries: DataFrame) -> DataFrame:
        """Clusters of which one has a member in an index block that a member
        of the other asks, sizes and positions allowing a link."""
        def lists(rows: DataFrame, suffix: str) -> DataFrame:
            of = rows.groupBy("token", "block", "cluster").agg(
                F.min("n").alias("least"), F.max("n").alias("most"), F.min("position").alias("position"))
            return of.select("token", "block", *(F.col(c).alias(c + suffix) for c in ("cluster", "least", "most", "position")))

        t = F.lit(self.percent)
        index = lists(entries.where(F.col("position") < index_length(F.col("n"), self.percent)), "a")
        # asking the block below its own, a set needs the overlap with the
        # least size there that could link at all
        below = F.col("block") - 1
        reachable = (F.col("mostb") - F.col("positionb")) * (100 + t) >= self.reach(F.col("leastb") * t / 100, F.col("leastb"))
        asking = lists(entries, "b").where(reachable).select("*", F.explode(F.array(below, F.col("block"))).alias("asked")).drop("block")
        index = index.withColumn("place", F.struct("token", "block")).drop("token", "block")
        asking = asking.withColumn("place", F.struct("token", F.col("asked").alias("block"))).drop("token", "asked")
        fit = (F.col("mosta") * 100 >= F.col("leastb") * t) & (F.col("leasta") <= F.col("mostb"))
        rest = F.least(F.col("mosta") - F.col("positiona"), F.col("mostb") - F.col("positionb"))
        enough = rest * (100 + t) >= self.reach(F.col("leasta"), F.greatest("leasta", "leastb"))
        joined = join_split(index, asking, "place", ["clustera"], ["clusterb"]).where((F.col("clustera") != F.col("clusterb")) & fit & enough)
        return joined.select(F.least("clustera", "clusterb").alias("a"), F.greatest("clustera", "clusterb").alias("b")).distinct()

    def _member_links(self, between: DataFrame, found: DataFrame, member: DataFrame, pivot_sets: DataFrame) -> DataFrame:
        """Links between members of clusters that the pivots leave open and
        that no link connects yet, each answer derived from a known one.

        First the members that may link are compared with the other cluster's
        pivot, one comparison a member; such a link closes the pair of
        clusters. For the others these answers bound the distances once more:
        x of A and y of B can link only if x is no further from B's pivot
        than the threshold and y's own distance from it together."""
        far = F.lit(self.farthest())
        roots = components(found)
        ra, rb = (roots.select(F.col("node").alias(s), F.col("root").alias(f"root_{s}")) for s in "ab")
        open_pairs = (between.join(ra, "a", "left").join(rb, "b", "left")
                      .where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b", "apart", "ra", "rb", "common"))
        open_pairs = materialize(open_pairs, "open")
        ends = open_pairs.select(F.explode(F.array("a", "b")).alias("cluster")).distinct()
        inside = member.join(ends, "cluster", "left_semi")
        known = self.bits.join(inside.select("sid").unionByName(ends.withColumnRenamed("cluster", "sid")).distinct(), "sid", "left_semi")
        known = materialize(known, "bits")
        inside = materialize(inside.join(known, "sid").select("cluster", "sid", "distance", "lost", "gained", F.col("n").alias("n_x"), F.col("bits").alias("bits_x")), "inside")
        centre = materialize(pivot_sets.join(ends.withColumnRenamed("cluster", "sid"), "sid", "left_semi"), "centre")

        def against_pivot(own: str, other: str) -> DataFrame:
            """Members of cluster ``own`` that may link into cluster ``other``."""
            asking = open_pairs.join(known.select(F.col("sid").alias(other), F.col("n").alias("n_y"), F.col("bits").alias("bits_y")), other)
            slack = F.col(f"r{other}")
            near = asking.join(inside.withColumnRenamed("cluster", own), own).where(
                (F.col("apart") - F.col("distance") <= far + slack) & self.may_link("x", "y", slack))
            return near.select(F.col("sid").alias("x"), F.col(other).alias("b"), "common", "lost", "gained", "n_x")

        # a member has one cluster, so it asks each other pivot once
        asked = against_pivot("a", "b").unionByName(against_pivot("b", "a"))
        asked = asked.join(centre.select(F.col("sid").alias("b"), "hashes"), "b").select("x", "b", "common", "lost", "gained", "n_x", "hashes")
        answered = materialize(asked.mapInArrow(derive_from_pivot, VERIFIED), "answered")
        links = answered.where(self.linked()).select("a", "b")
        of = member.select(F.col("sid").alias("a"), "cluster")
        closed = links.join(of, "a").select(F.least("cluster", "b").alias("a"), F.greatest("cluster", "b").alias("b")).distinct()
        left_open = open_pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).join(closed, ["a", "b"], "left_anti")

        x = (answered.where(~self.linked()).withColumn("to_pivot", self.apart())
             .join(inside.select(F.col("sid").alias("a"), "cluster", "lost", "gained", "n_x", "bits_x"), "a")
             .select(F.col("a").alias("x"), F.col("cluster").alias("a"), "b", "to_pivot", "common", "lost", "gained", "n_x", "bits_x")
             .join(left_open, ["a", "b"], "left_semi"))
        y = inside.select(F.col("cluster").alias("b"), F.col("sid").alias("y"), "distance", F.col("lost").alias("lost_y"), F.col("gained").alias("gained_y"),
                          F.col("n_x").alias("n_y"), F.col("bits_x").alias("bits_y"))
        pairs = x.join(y, "b").where((F.col("to_pivot") <= far + F.col("distance")) & self.may_link("x", "y", F.lit(0.0)))
        pairs = pairs.join(centre.select(F.col("sid").alias("a"), "hashes"), "a").select(
            "x", "y", "common", "lost", "gained", "lost_y", "gained_y", "n_x", "n_y", "hashes")
        return links.unionByName(pairs.mapInArrow(derive_members, VERIFIED).where(self.linked()).select("a", "b"))

    def labelled_sets(self) -> DataFrame:
        """Every set (sid) with its component's root and the smallest doc_id
        of its rows (NULL if all are)."""
        sets = self.rows.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("first"))
        roots = components(self.links())
        return sets.join(roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))

    def documents(self) -> DataFrame:
        """doc_id, n_shingles, component_id, set_id of every row."""
        labelled = materialize(self.labelled_sets(), "labelled")
        smallest = materialize(labelled.groupBy("root").agg(F.min("first").alias("component_id")), "smallest")
        of_set = labelled.join(smallest, "root").select("sid", "component_id")
        joined = self.rows.join(of_set, "sid", "left")
        return joined.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.col("sid").alias("set_id"))

    def survivors(self) -> DataFrame:
        """One (doc_id, sid) of each component: the smallest doc_id, NULL
        last; of its sets the smallest id."""
        smallest = F.min(F.struct(F.col("first").isNull().alias("none"), "first", "sid")).alias("m")
        return self.labelled_sets().groupBy("root").agg(smallest).select(F.col("m.first").alias("doc_id"), F.col("m.sid").alias("sid"))


def similar_components(docs: DataFrame, words: int = 5, percent: int = 80, id_bits: int = 64) -> DataFrame:
    """Every row's set size, component (smallest doc_id that links reach) and
    set id. ``docs`` needs doc_id and text."""
    return JaccardJoin(docs, words, percent, id_bits).documents()


def with_set_ids(names: SetIds, k: int, text: int, name: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows with the id of their set, NULL without shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = binary_texts(batch.column(text)), []
            for a, b in blocks(texts):
                sets = ShingleSets(texts[a:b], k)
                ids.append(pa.array(names.of(sets), mask=sets.size == 0))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.concat_arrays(ids) if ids else pa.array([], pa.int64())], [*batch.schema.names, name])
    return run


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80, id_bits: int = 64) -> DataFrame:
    """``docs`` (all columns) with one row of each component: the smallest
    doc_id, NULL last. Rows without shingles stay. Rows are told apart by
    doc_id and set id, so repeated and NULL doc_ids may hold any texts; of
    rows equal in both the one with the smallest text stays."""
    sid, of_id, of_set, n = (fresh_name(c, docs.columns) for c in ("_sid", "_of_id", "_of_set", "_nth"))
    join = JaccardJoin(docs, words, percent, id_bits)
    one = materialize(join.survivors(), "survivors")
    same = F.col("r.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("r.sid") == F.col("s.sid"))
    pairs = join.rows.where("n > 0").groupBy("doc_id", "sid").agg(F.count("*").alias("copies")).alias("r")
    named = (F.col("doc_id").alias(of_id), F.col("sid").alias(of_set))
    gone = pairs.join(one.alias("s"), same, "left_anti").select(*named)
    copied = materialize(pairs.where("copies > 1").join(one.alias("s"), same, "left_semi").select(*named), "copied")
    schema = T.StructType([*docs.schema.fields, T.StructField(sid, T.LongType())])
    rows = docs.mapInArrow(with_set_ids(join.names, words, docs.columns.index("text"), sid), schema)
    here = (F.col(sid) == F.col(of_set)) & F.col("doc_id").cast("long").eqNullSafe(F.col(of_id))
    kept = rows.join(gone, here, "left_anti")
    if copied.isEmpty():
        return kept.select(*docs.columns)
    by = Window.partitionBy("doc_id", sid).orderBy("text")
    first = rows.join(copied, here, "left_semi").withColumn(n, F.row_number().over(by)).where(F.col(n) == 1)
    return kept.join(copied, here, "left_anti").select(*docs.columns).unionByName(first.select(*docs.columns))
