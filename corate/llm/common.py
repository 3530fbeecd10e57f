"""Helpers shared by the text operators: table reading, scratch tables in
the cluster's shared folder, bounded samples, and vectorised word hashing
over blocks of Arrow text."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step handles; a longer text is one block.
BLOCK_BYTES = 1 << 20
#: What one step takes of a very long text, so that its memory stays bounded.
SLICE_BYTES = 4 << 20
#: Rows of one Arrow batch.
BATCH_ROWS = 1000

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one input table."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it,
    and hand texts to them in batches of BATCH_ROWS at most: a batch of
    Spark's default size holds ten times the memory, in the JVM and in the
    worker."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = ":".join([*paths, _ROOT])
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def crc_fold(doc_id: Column | str, folds: int) -> Column:
    """crc32(doc_id as text) mod ``folds``; NULL for a NULL id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string")) % folds


#: Buckets of one histogram of hashes, as bits of the hash.
SAMPLE_BITS = 12


def bounded_sample(df: DataFrame, key: str, rows: int, bits: int = SAMPLE_BITS) -> DataFrame:
    """The ``rows`` first rows by hash of the key, then of the content (all if
    fewer).

    Only for fitting classifiers: the bound is the documented parameter. The
    choice depends on the rows alone, not on how they lie in partitions.
    Rows that tie are equal, so repeated and NULL keys are chosen like any
    other; equal rows beyond the bound are left out one by one.

    Histograms of the leading bits of the key's hash narrow down which rows
    can be among the first, until few more than ``rows`` are left, whatever
    the size of the table; only those are read whole and sorted. Where a
    single key has more rows than that, the hash of their content goes on."""
    content = F.xxhash64(*[F.col(c) for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind], F.lit("content"))
    return _first_by(df, [F.xxhash64(F.col(key), F.lit("fit")), content], rows, bits)


def _first_by(df: DataFrame, hashes: list[Column], rows: int, bits: int) -> DataFrame:
    """The ``rows`` first rows in order of ``hashes``. A histogram has 2**bits
    rows at most."""
    lead = F.shiftrightunsigned(hashes[0], 1)
    low, width = 0, 63  # the range of hashes whose rows are still to be told apart
    below = 0           # rows of smaller hashes, all chosen
    while True:
        width = max(0, width - bits)
        bucket = F.shiftright(lead, width)
        inside = df if low == 0 else df.where((lead >= low) & (bucket < (low >> width) + (1 << bits)))
        counts = sorted(tuple(r) for r in inside.groupBy(bucket.alias("b")).count().collect())
        if low == 0 and sum(n for _, n in counts) <= rows:
            return df
        for b, n in counts:
            if below + n >= rows:
                break
            below += n
        if below + n <= 2 * rows or width == 0:
            break
        low = b << width
    if below + n > 2 * rows and len(hashes) > 1:
        return df.where(lead < b).unionByName(_first_by(df.where(lead == b), hashes[1:], rows - below, bits))
    h, order = fresh_name("_h", df.columns), [F.shiftrightunsigned(c, 1) for c in hashes]
    # the limit makes one partition; dealt out again, tasks share the work
    chosen = df.where(bucket <= b).withColumn(h, F.xxhash64(*hashes)).orderBy(*order).limit(rows)
    return chosen.repartition(h).drop(h)


def row_blocks(rows: DataFrame, size: Column, limit: int) -> Iterator[list]:
    """All rows, in lists whose ``size`` adds up to ``limit`` at most (or of
    one row), fetched one after the other: for a stated query set that is
    broadcast block by block. Rows go to blocks by hash; a block that turns
    out larger is dealt out again."""
    pending = [(rows, 0)]
    while pending:
        part, level = pending.pop()
        total, n = part.agg(F.coalesce(F.sum(size), F.lit(0)), F.count("*")).first()
        if total > limit and n > 1 and level < 8:
            k = 2 * -(-total // limit)
            own = F.pmod(F.xxhash64(*rows.columns, F.lit(level)), F.lit(k))
            pending += [(part.where(own == b), level + 1) for b in range(k)]
        elif n:
            yield part.collect()


def fresh_name(name: str, taken: list[str]) -> str:
    """``name``, or a longer one where columns are called so already (names
    of columns don't differ by case alone)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def binary_texts(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [b or b"" for b in column.cast(pa.large_binary()).to_pylist()]


def blocks(texts: list[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``limit`` bytes together."""
    first = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield first, i
            first, size = i, 0
        size += len(t) + 1
    if first < len(texts):
        yield first, len(texts)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and odd multipliers)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_BASE = 0x5851F42D4C957F2D
_powers: list[np.ndarray] = []


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + 1024)
        inverse = pow(_BASE, -1, 1 << 64)
        with np.errstate(over="ignore"):
            _powers[:] = [np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size, b, np.uint64)))) for b in (_BASE, inverse)]
    return _powers[0], _powers[1]


def _word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of each word, whatever its place, from running sums
    over slices of about SLICE_BYTES that end with a word."""
    out, i = np.empty(len(start), np.uint64), 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + SLICE_BYTES, side="right")))
        a, b = start[i:j] - start[i], end[i:j] - start[i]
        part = data[start[i] : end[j - 1]]
        power, inverse = power_tables(len(part) + 1)
        total = np.zeros(len(part) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[: len(part)], out=total[1:])
            out[i:j] = mix64((total[b] - total[a]) * inverse[a] + (b - a).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))
        i = j
    return out


def text_slices(text: str) -> Iterator[str]:
    """A text in slices of about SLICE_BYTES characters, cut before blanks."""
    at = 0
    while len(text) - at > SLICE_BYTES and (cut := text.find(" ", at + SLICE_BYTES)) >= 0:
        yield text[at:cut]
        at = cut
    yield text[at:]


class Words:
    """Words of a block of byte texts: 64-bit hash of each word and the row
    it stands in, found without a Python loop over words.

    ``is_word`` is a 256-entry boolean table of the bytes that words hold."""

    def __init__(self, texts: list[bytes], is_word: np.ndarray):
        data = np.frombuffer(b"\x20".join(texts) + b"\x20", np.uint8)
        mask = is_word[data]
        edge = np.flatnonzero(mask[1:] != mask[:-1]) + 1
        if len(mask) and mask[0]:
            edge = np.concatenate(([0], edge))
        self.start, self.end = edge[0::2], edge[1::2]
        self.hash = _word_hashes(data, self.start, self.end)
        self.text_start = np.cumsum([0, *(len(t) + 1 for t in texts)])
        #: row r holds words first[r] to first[r + 1]
        self.first = np.searchsorted(self.start, self.text_start)
        self.count = np.diff(self.first)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all k-word windows that lie in one row, and the index
        of each window's first word."""
        n = len(self.hash)
        if n < k:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        with np.errstate(over="ignore"):
            h = self.hash[: n - k + 1].copy()
            for i in range(1, k):
                h = h * np.uint64(0x9FB21C651E98DF25) + self.hash[i : n - k + 1 + i]
            h = mix64(h)
        row = np.repeat(np.arange(len(self.count)), self.count)
        at = np.flatnonzero(row[: n - k + 1] == row[k - 1 :])
        return h[at], at

    def window(self, first: int, n: int) -> np.uint64:
        """Hash of the n words from word ``first`` on; never that of a window
        of another length, as far as 64 bits go."""
        with np.errstate(over="ignore"):
            h = np.uint64(n) * np.uint64(0xE7037ED1A0B428DB)
            for w in self.hash[first : first + n]:
                h = h * np.uint64(0x9FB21C651E98DF25) + w
            return mix64(np.array([h]))[0]


def byte_table(pattern_bytes: bytes) -> np.ndarray:
    """Table that is True for all bytes but the given ones."""
    table = np.ones(256, bool)
    table[list(pattern_bytes)] = False
    return table


#: Bytes that separate the words ``[^\x20\x09-\x0D]+``.
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
