"""Exact deduplication by Grace hashing.

Each map task first folds its own copies in an open-addressing table that
compares complete contents, so a group of copies ships at most one content
a task and table flush, however large it is. The distinct contents are
then partitioned by hash over the cluster, and each task partitions its
share recursively into spill files until a bucket fits the table. Spill
files are private scratch of one task attempt: they are removed when the
bucket is done, and a lost executor's task writes its own anew.

Defined results: NULL text counts as empty; a NULL doc_id counts as smaller
than any; repeated rows are rows of the same group; an empty table gives an
empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import os
import struct
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corate.llm.common import binary_texts, fresh_name

#: Bytes of content one open-addressing table may hold.
TABLE_BYTES = 48 << 20
#: Buckets of one level of spilling.
FANOUT = 16

GROUP_SCHEMA = "content binary, digest string, largest_id long, rows long"


def normalise(text: bytes) -> bytes:
    """Lower-case A-Z only (bytes.lower leaves all others as they are)."""
    return text.lower()


class ContentTable:
    """Open addressing with linear probing: a slot holds an entry's number;
    entries of equal hash are told apart by their complete content."""

    def __init__(self):
        self.slots = np.full(1024, -1, np.int64)
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.digests: list[str] = []
        self.largest: list[int | None] = []
        self.rows: list[int] = []
        self.bytes = 0

    def add(self, h: int, content: bytes, digest: str, largest: int | None, rows: int) -> None:
        size = len(self.slots)
        at = h & (size - 1)
        while (e := self.slots[at]) >= 0:
            if self.hashes[e] == h and self.contents[e] == content:
                if largest is not None and (self.largest[e] is None or largest > self.largest[e]):
                    self.largest[e] = largest
                self.rows[e] += rows
                return
            at = (at + 1) & (size - 1)
        self.slots[at] = len(self.contents)
        self.hashes.append(h)
        self.contents.append(content)
        self.digests.append(digest)
        self.largest.append(largest)
        self.rows.append(rows)
        self.bytes += len(content) + 200
        if 2 * len(self.contents) > size:
            self._grow()

    def _grow(self) -> None:
        size = 4 * len(self.slots)
        self.slots = np.full(size, -1, np.int64)
        for e, h in enumerate(self.hashes):
            at = h & (size - 1)
            while self.slots[at] >= 0:
                at = (at + 1) & (size - 1)
            self.slots[at] = e

    def batches(self) -> Iterator[pa.RecordBatch]:
        """The entries in batches of bounded size."""
        first = size = 0
        for i in range(len(self.contents) + 1):
            if i == len(self.contents) or size > (8 << 20):
                if i > first:
                    yield pa.RecordBatch.from_arrays([
                        pa.array(self.contents[first:i], pa.binary()),
                        pa.array(self.digests[first:i], pa.string()),
                        pa.array(self.largest[first:i], pa.int64()),
                        pa.array(self.rows[first:i], pa.int64()),
                    ], ["content", "digest", "largest_id", "rows"])
                first, size = i, 0
            if i < len(self.contents):
                size += len(self.contents[i])


def _hash(digest: str, level: int) -> int:
    """A hash from other hex digits of the digest at each level of spilling."""
    at = 6 * (level % 8)
    return int(digest[at : at + 16], 16) & 0x7FFFFFFFFFFFFFFF


def fold_copies(table_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Map side: (doc_id, text) rows to one row per content and table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ContentTable()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), binary_texts(batch.column(1)), strict=True):
                content = normalise(text)
                digest = hashlib.sha256(content).hexdigest()
                table.add(_hash(digest, 0), content, digest, doc_id, 1)
                if table.bytes > table_bytes:
                    yield from table.batches()
                    table = ContentTable()
        yield from table.batches()
    return run


class SpillFiles:
    """One file per bucket of a level; rows go out as length-prefixed records."""

    RECORD = struct.Struct("<I64sqq?")

    def __init__(self, folder: str, level: int):
        self.level = level
        self.paths = [os.path.join(folder, f"{level}-{os.urandom(6).hex()}-{b}") for b in range(FANOUT)]
        self.files = [open(p, "wb", buffering=1 << 16) for p in self.paths]

    def add(self, content: bytes, digest: str, largest: int | None, rows: int) -> None:
        f = self.files[(_hash(digest, self.level) >> 24) % FANOUT]
        f.write(self.RECORD.pack(len(content), digest.encode(), largest or 0, rows, largest is None))
        f.write(content)

    def close(self) -> list[str]:
        for f in self.files:
            f.close()
        return self.paths

    @classmethod
    def read(cls, path: str) -> Iterator[tuple[bytes, str, int | None, int]]:
        with open(path, "rb", buffering=1 << 16) as f:
            while head := f.read(cls.RECORD.size):
                n, digest, largest, rows, null = cls.RECORD.unpack(head)
                yield f.read(n), digest.decode(), None if null else largest, rows


def _grace(rows: Iterator[tuple[bytes, str, int | None, int]], level: int, table_bytes: int, folder: str) -> Iterator[ContentTable]:
    """Tables that together hold all rows, each content in one table only."""
    table, spill = ContentTable(), None
    for content, digest, largest, n in rows:
        if spill is None:
            table.add(_hash(digest, level), content, digest, largest, n)
            if table.bytes > table_bytes and len(table.contents) > 1:
                spill = SpillFiles(folder, level + 1)
                for e in range(len(table.contents)):
                    spill.add(table.contents[e], table.digests[e], table.largest[e], table.rows[e])
                table = ContentTable()
        else:
            spill.add(content, digest, largest, n)
    if spill is None:
        yield table
        return
    for path in spill.close():
        if os.path.getsize(path):
            yield from _grace(SpillFiles.read(path), level + 1, table_bytes, folder)
        os.remove(path)


def grace_groups(table_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Reduce side: one row per content of the task's partition; contents of
    one digest are numbered, so equal digests never join different texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)

        with tempfile.TemporaryDirectory() as folder:
            for table in _grace(rows(), 0, table_bytes, folder):
                if len(set(table.digests)) < len(table.digests):
                    raise ValueError("two different texts share a SHA-256 digest")
                yield pa.RecordBatch.from_arrays([
                    pa.array(table.digests, pa.string()),
                    pa.array(table.largest, pa.int64()),
                    pa.array(table.rows, pa.int64()),
                ], ["digest", "keep_id", "group_size"])
    return run


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, digest of the normalised text) of every row."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([
            batch.column(0),
            pa.array([hashlib.sha256(normalise(t)).hexdigest() for t in binary_texts(batch.column(1))], pa.string()),
        ], ["doc_id", "digest"])


def content_groups(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per distinct content: digest, keep_id (largest doc_id) and
    group_size. ``docs`` needs doc_id and text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    folded = rows.mapInArrow(fold_copies(table_bytes), GROUP_SCHEMA)
    return folded.repartition("digest").mapInArrow(grace_groups(table_bytes), "digest string, keep_id long, group_size long")


def exact_groups(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """Every row with its group: doc_id, keep_id, group_size, kept, text_sha256.

    The rows' digests join the groups' (both sides are narrow; AQE splits the
    partition of a digest that many rows carry)."""
    members = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(digests, "doc_id long, digest string")
    joined = members.join(content_groups(docs, table_bytes), "digest")
    return joined.select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def keep_one(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """``docs`` with all columns, one row of each content: that with the
    largest doc_id (any one of rows that repeat both)."""
    digest, of_id, of_digest = (fresh_name(c, docs.columns) for c in ("_digest", "_keep_id", "_keep_digest"))
    keep = content_groups(docs, table_bytes).select(F.col("keep_id").alias(of_id), F.col("digest").alias(of_digest))
    marked = docs.mapInArrow(with_digest(digest), T.StructType([*docs.schema.fields, T.StructField(digest, T.StringType())]))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(of_id)) & (F.col(digest) == F.col(of_digest))
    return marked.join(keep, same, "left_semi").dropDuplicates(["doc_id", digest]).select(*docs.columns)


def with_digest(name: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """All columns and the digest of the normalised text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = binary_texts(batch.column(batch.schema.get_field_index("text")))
            yield batch.append_column(name, pa.array([hashlib.sha256(normalise(t)).hexdigest() for t in texts], pa.string()))
    return run
