"""Ranked lexical search, reversed: the items are indexed, the documents
stream past.

The items' terms make an inverted index (term -> items that hold it and how
often), which is broadcast; every document's term counts run through it, and
each task keeps a bounded heap of the best documents per item. The heaps of
all tasks are merged by Spark.

Items are taken in blocks whose text is measured before a block's index is
built, so a broadcast never holds more than ``ITEM_BYTES`` of item text (one
item, where a single one is longer) however many items there are. Two passes
a block: the first counts the terms of every whole text and writes, per
document, its length and its counts of the items' terms; N, L and the
document frequencies are sums over that table, and the second pass scores it.

Terms are maximal runs of ASCII letters, digits and characters beyond ASCII,
with A-Z lower-cased. Scores are whole numbers (see ``term_weight`` and
``contribution``).

Defined results: a NULL or empty text, or one without a term, is no document
of N and is never found; an item without a term, NULL included, finds
nothing. Rows of ``items`` that repeat an item_id are items of their own.
Equal scores are ordered by ascending doc_id, NULL last; rows that repeat
doc_id and score take consecutive ranks. Very long texts are counted slice by
slice. Empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corate.config import materialize
from corate.llm.common import SLICE_BYTES, row_blocks

#: Bytes of item text in one block, and so in one broadcast index.
ITEM_BYTES = 4 << 20
#: What one step scores at once: cells of its matrix of documents and items,
#: and postings that its documents can meet at most.
SCORE_CELLS = 1 << 20
STEP_POSTINGS = 1 << 22
#: First-stage groups per item when the tasks' heaps are merged.
MERGE_GROUPS = 32

#: Fixed values of the ranking formula: scale of a term's weight, of its
#: saturation, and the length normalisation in hundredths.
WEIGHT_SCALE = 1000
GAIN = 1_000_000_000
TF_SCALE = 1000
LENGTH_SCALE = 12
LENGTH_SHARE = 25

_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


def terms_of(text: str | None) -> Iterator[bytes]:
    """The terms of a whole text, in order."""
    data = (text or "").encode().lower()  # bytes.lower changes A-Z only
    at = 0
    while len(data) - at > SLICE_BYTES and (cut := data.find(b" ", at + SLICE_BYTES)) >= 0:
        yield from _TERM.findall(data, at, cut)
        at = cut
    yield from _TERM.findall(data, at)


def term_weight(n_docs: int, df: int) -> int:
    """floor(1000 ln((2N + 2) / (2 df + 1))), in doubles."""
    return math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_norm(n: int, n_docs: int, total: int) -> int:
    """A document's m: 75 for an empty one, 100 for one of average length."""
    return 100 - LENGTH_SHARE + (LENGTH_SHARE * n * n_docs) // total


class ItemIndex:
    """Inverted index of a block of items: term -> number, and per term the
    items that hold it with their counts, as slices of two arrays."""

    def __init__(self, texts: list[str | None]):
        self.n_items = len(texts)
        self.number: dict[bytes, int] = {}
        postings: list[list[tuple[int, int]]] = []
        for item, text in enumerate(texts):
            for term, n in Counter(terms_of(text)).items():
                t = self.number.setdefault(term, len(self.number))
                if t == len(postings):
                    postings.append([])
                postings[t].append((item, n))
        self.first = np.cumsum([0, *(len(p) for p in postings)])
        flat = [x for p in postings for x in p]
        self.item = np.array([i for i, _ in flat], np.int64)
        self.times = np.array([n for _, n in flat], np.int64)

    def counts(self, text: str | None) -> tuple[int, list[tuple[int, int]]]:
        """The number of a text's terms, and (term number, count) of those
        that are items'."""
        found = Counter(terms_of(text))
        known = ((self.number.get(t), n) for t, n in found.items())
        return found.total(), sorted((t, n) for t, n in known if t is not None)


COUNT_SCHEMA = "doc_id long, n long, terms array<int>, tf array<int>"


def count_terms(index) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(doc_id, text) rows to the term counts of rows that hold a term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                n, known = index.value.counts(text.as_py())
                if n:
                    rows.append((doc_id, n, [t for t, _ in known], [c for _, c in known]))
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "n", "terms", "tf"])
    return run


class Heaps:
    """The best ``k`` (score, doc_id) of each item so far; of equal scores the
    smaller doc_id is better, NULL the worst."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.heaps: list[list[tuple[int, bool, int]]] = [[] for _ in range(n_items)]
        #: what a score must reach to enter an item's heap
        self.least = np.ones(n_items, np.int64)

    def offer(self, scores: np.ndarray, doc_ids: list[int | None]) -> None:
        """Scores of some documents (rows) for all items (columns)."""
        for row, item in zip(*np.nonzero(scores >= self.least), strict=True):
            doc_id, heap = doc_ids[row], self.heaps[item]
            entry = (int(scores[row, item]), doc_id is not None, -(doc_id or 0))
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.k:
                self.least[item] = heap[0][0]

    def batch(self) -> pa.RecordBatch:
        rows = [(i, -d if known else None, s) for i, heap in enumerate(self.heaps) for s, known, d in heap]
        kinds = (pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 3, kinds, strict=True)], ["item", "doc_id", "score"])


def score_counts(index, weights, n_docs: int, total: int, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Term counts to the task's best ``k`` documents per item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix, weight = index.value, np.array(weights.value, np.int64)
        heaps = Heaps(ix.n_items, k)
        step = max(1, min(SCORE_CELLS // max(1, ix.n_items), STEP_POSTINGS // max(1, len(ix.item))))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                n = part.num_rows
                m = np.array([length_norm(x, n_docs, total) for x in part.column(1).to_pylist()], np.int64)
                per_doc = np.array([len(x) for x in part.column(2)], np.int64)
                doc = np.repeat(np.arange(n), per_doc)
                term, tf = (part.column(i).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3))
                gain = weight[term] * ((GAIN * tf) // (TF_SCALE * tf + LENGTH_SCALE * m[doc]))
                # every posting of every term of every document, in one array
                size = ix.first[term + 1] - ix.first[term]
                begin = np.repeat(ix.first[term] - np.cumsum(size) + size, size)
                posting = begin + np.arange(len(begin))
                cell = np.repeat(doc, size) * ix.n_items + ix.item[posting]
                scores = np.zeros(n * ix.n_items, np.int64)
                np.add.at(scores, cell, np.repeat(gain, size) * ix.times[posting])
                heaps.offer(scores.reshape(n, ix.n_items), part.column(0).to_pylist())
        yield heaps.batch()
    return run


def search(docs: DataFrame, items: DataFrame, k: int = 20, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The ``k`` best documents with a score above 0 of each item: item_id,
    rank (from 1), doc_id, score. ``docs`` needs doc_id and text, ``items``
    item_id and text."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = None
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 16
    for block in row_blocks(items.select("item_id", "text"), size, item_bytes):
        one = _search_block(rows, block, k)
        found = one if found is None else found.unionByName(one)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return found


def _search_block(rows: DataFrame, block: list, k: int) -> DataFrame:
    spark = rows.sparkSession
    broadcast = spark.sparkContext.broadcast
    index = ItemIndex([r.text for r in block])
    shared = broadcast(index)
    counted = materialize(rows.mapInArrow(count_terms(shared), COUNT_SCHEMA), "term-counts")
    n_docs, total = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # one row a term of the block's items at most
    df = dict(tuple(r) for r in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
    weights = broadcast([term_weight(n_docs, df.get(t, 0)) for t in range(len(index.number))])
    best = counted.where(F.size("terms") > 0).mapInArrow(
        score_counts(shared, weights, n_docs, total, k), "item long, doc_id long, score long")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    group = F.pmod(F.xxhash64("doc_id"), F.lit(MERGE_GROUPS))
    first = best.withColumn("group", group).withColumn("rank", F.row_number().over(Window.partitionBy("item", "group").orderBy(*order)))
    last = first.where(F.col("rank") <= k).withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    ids = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(block)], "item long, item_id long")
    return last.where(F.col("rank") <= k).join(ids, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
