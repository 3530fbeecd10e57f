"""Hard-negative mining by a vertical scan (BOND: branch and bound on
decomposed data).

Rows lie in blocks of columns, one per dimension. For every anchor the
dimensions are read in descending order of the anchor's magnitude; after
each step the largest and least that the dimensions still unread can add
(from the block's minimum and maximum per dimension) bound every candidate's
score, and candidates that can't matter any more leave the bitmap. What is
left after the last dimension has its exact score.

Two scans over all rows: the first finds each anchor's best rows of its own
label (the positives), whose exact scores set windows; the second finds, for
each anchor and positive, the best rows of other labels inside the window.
Every task keeps bounded heaps per anchor, and Spark merges them. Anchors are
the stated query set: they are broadcast in blocks of ``ANCHOR_CELLS``
components at most, whatever their number.

Components x become floor(scale * x); a score is the whole-number inner
product. It is summed in doubles where a block's largest possible score
stays below 2^53, in Python's whole numbers otherwise, so it is exact either
way (and cut to 64 bits when it is returned).

Defined results: rows with a NULL label, a NULL vector, or a NULL or
non-finite component (scaled or not) take no part; a shorter vector counts as filled up with
zeros. Rows of an anchor's own id are never its positives. Rows with a NULL
id take part, but are no anchors; equal scores go by ascending id, NULL last.
Repeated rows are rows of their own; a repeated anchor gives its rows again.
Empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corate.config import materialize
from corate.llm.common import row_blocks

#: Components of the anchors of one broadcast block.
ANCHOR_CELLS = 1 << 20
#: Components of one block of rows in a task.
BLOCK_CELLS = 1 << 21
#: Dimensions of the first step; every step reads twice as many as the last.
FIRST_STEP = 8
#: First-stage groups per anchor when the tasks' heaps are merged.
MERGE_GROUPS = 16

#: Bound below which sums of whole numbers in doubles are exact.
EXACT = float(1 << 53)

FOUND_SCHEMA = "anchor long, slot long, vec_id long, score long"


class Anchors(NamedTuple):
    """A block of anchors; per anchor the windows (low, high) of its
    positives' scores, empty in the first scan."""

    ids: list[int]
    labels: list[int]
    vectors: np.ndarray
    windows: list[list[tuple[int, int]]]


def usable(rows: DataFrame, vector: str, scale: float) -> DataFrame:
    """vec_id, label, vector (doubles) of the rows that take part."""
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < F.lit(float("inf"))))
    return (rows.where(F.col("label").isNotNull() & F.col(vector).isNotNull()).where(finite)
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                    F.col(vector).cast("array<double>").alias("vector")))


def matrix(vectors: list, width: int, scale: float) -> np.ndarray:
    """floor(scale * x) of each vector as a row, filled up with zeros."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = np.floor(scale * np.asarray(v, np.float64))
    return out


def flat_matrix(column: pa.ListArray, width: int, scale: float) -> np.ndarray:
    """The same from an Arrow column, without a loop where lengths agree."""
    lengths = np.diff(column.offsets.to_numpy())
    if len(lengths) and (lengths == width).all():
        return np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width))
    return matrix(column.to_pylist(), width, scale)


class Block:
    """Rows as columns, sorted by label so that a label's rows are a range."""

    def __init__(self, ids: list[int | None], labels: np.ndarray, rows: np.ndarray):
        order = np.argsort(labels, kind="stable")
        self.ids = [ids[i] for i in order]
        self.key = np.array([(i is None, i or 0) for i in self.ids], "?,i8")
        self.labels = labels[order]
        self.columns = np.ascontiguousarray(rows[order].T)
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)

    def of_label(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.labels, label)), int(np.searchsorted(self.labels, label, side="right"))

    def bound(self, anchors: np.ndarray) -> float:
        """No score of the block with any of the anchors is larger in size."""
        reach = np.maximum(np.abs(self.low), np.abs(self.high))
        return float(np.abs(anchors).max(axis=0) @ reach) if len(anchors) else 0.0

    def exact(self) -> None:
        """Whole numbers of any size from here on."""
        whole = np.frompyfunc(int, 1, 1)
        self.columns, self.low, self.high = whole(self.columns), whole(self.low), whole(self.high)

    def scan(self, anchor: np.ndarray, rows: np.ndarray, alive: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Rows that ``alive(least, most)`` (bounds of their scores) keeps to
        the end, and their exact scores."""
        order = np.argsort(-np.abs(anchor.astype(np.float64)), kind="stable")
        a = anchor[order]
        up, down = np.where(a > 0, self.high[order], self.low[order]), np.where(a > 0, self.low[order], self.high[order])
        zero = np.zeros(1, a.dtype)
        rest_most = np.concatenate((np.cumsum((a * up)[::-1])[::-1], zero))
        rest_least = np.concatenate((np.cumsum((a * down)[::-1])[::-1], zero))
        partial, at, step = np.zeros(len(rows), a.dtype), 0, FIRST_STEP
        while at < len(a) and len(rows):
            read = order[at : at + step]
            partial = partial + a[at : at + step] @ (self.columns[read][:, rows])
            at, step = min(at + step, len(a)), 2 * step
            keep = alive(partial + rest_least[at], partial + rest_most[at])
            if not keep.all():
                rows, partial = rows[keep], partial[keep]
        return rows, partial


class Heaps:
    """The best ``k`` (score, vec_id) per anchor and slot; of equal scores
    the smaller id is better, NULL the worst."""

    def __init__(self, k: int):
        self.k = k
        self.heaps: dict[tuple[int, int], list[tuple[int, bool, int]]] = {}

    def least(self, anchor: int, slot: int) -> int | None:
        """The score of the worst of ``k``, None while there are fewer."""
        heap = self.heaps.get((anchor, slot), ())
        return heap[0][0] if len(heap) == self.k else None

    def offer(self, anchor: int, slot: int, block: Block, rows: np.ndarray, scores: np.ndarray) -> None:
        if len(rows) == 0:
            return
        best = np.lexsort((block.key["f1"][rows], block.key["f0"][rows], -scores))[: self.k]
        heap = self.heaps.setdefault((anchor, slot), [])
        for i in best:
            vec_id = block.ids[rows[i]]
            entry = (int(scores[i]), vec_id is not None, -(vec_id or 0))
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)

    def batches(self, size: int = 20_000) -> Iterator[pa.RecordBatch]:
        rows = [(a, s, -d if known else None, min(max(score, -(1 << 63)), (1 << 63) - 1))
                for (a, s), heap in self.heaps.items() for score, known, d in heap]
        for at in range(0, len(rows), size):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[at : at + size], strict=True)], ["anchor", "slot", "vec_id", "score"])


def best_of_label(block: Block, n: int, anchors: Anchors, heaps: Heaps) -> None:
    """First scan: the best rows of the anchor's label but its own id."""
    first, last = block.of_label(anchors.labels[n])
    rows = np.arange(first, last)
    own = (~block.key["f0"][first:last]) & (block.key["f1"][first:last] == anchors.ids[n])
    rows = rows[~own]

    def alive(least: np.ndarray, most: np.ndarray) -> np.ndarray:
        floor = heaps.least(n, 0)
        if len(least) > heaps.k:
            surely = np.partition(least, len(least) - heaps.k)[len(least) - heaps.k]
            floor = surely if floor is None else max(floor, surely)
        return np.ones(len(most), bool) if floor is None else most >= floor

    heaps.offer(n, 0, block, *block.scan(anchors.vectors[n], rows, alive))


def best_in_windows(block: Block, n: int, anchors: Anchors, heaps: Heaps) -> None:
    """Second scan: the best rows of other labels inside each window."""
    windows = anchors.windows[n]
    if not any(low <= high for low, high in windows):
        return
    first, last = block.of_label(anchors.labels[n])
    rows = np.concatenate((np.arange(first), np.arange(last, len(block.ids))))

    def floors() -> list[tuple[int, int]]:
        worst = [heaps.least(n, slot) for slot in range(len(windows))]
        return [(low if w is None else max(low, w), high) for (low, high), w in zip(windows, worst, strict=True)]

    now = list(dict.fromkeys(floors()))

    def alive(least: np.ndarray, most: np.ndarray) -> np.ndarray:
        keep = np.zeros(len(least), bool)
        for low, high in now:
            keep |= (most >= low) & (least <= high)
        return keep

    rows, scores = block.scan(anchors.vectors[n], rows, alive)
    for slot, (low, high) in enumerate(floors()):
        inside = ((scores >= low) & (scores <= high)).astype(bool)
        heaps.offer(n, slot, block, rows[inside], scores[inside])


def vertical_scan(shared, k: int, scale: float, look: Callable) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(vec_id, label, vector) rows to the task's heaps."""
    def blocks_of(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[Block]:
        held: list[pa.RecordBatch] = []
        cells = 0
        for batch in batches:
            widest = max(np.diff(batch.column(2).offsets.to_numpy()), default=0)
            step = max(1, BLOCK_CELLS // max(1, widest, width))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                if held and cells + part.num_rows * max(1, widest, width) > BLOCK_CELLS:
                    yield whole(held, width)
                    held, cells = [], 0
                held.append(part)
                cells += part.num_rows * max(1, widest, width)
        if held:
            yield whole(held, width)

    def whole(held: list[pa.RecordBatch], width: int) -> Block:
        table = pa.Table.from_batches(held).combine_chunks()
        ids, labels, vectors = (table.column(i).combine_chunks() for i in range(3))
        widest = max(width, int(max(np.diff(vectors.offsets.to_numpy()), default=0)))
        return Block(ids.to_pylist(), labels.to_numpy(), flat_matrix(vectors, widest, scale))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, heaps = shared.value, Heaps(k)
        for block in blocks_of(batches, anchors.vectors.shape[1]):
            own = anchors
            if (more := len(block.columns) - anchors.vectors.shape[1]) > 0:
                own = own._replace(vectors=np.pad(own.vectors, ((0, 0), (0, more))))
            if block.bound(own.vectors) >= EXACT:
                block.exact()
                own = own._replace(vectors=np.frompyfunc(int, 1, 1)(own.vectors))
            for n in range(len(own.ids)):
                look(block, n, own, heaps)
        yield from heaps.batches()
    return run


def merged(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of all tasks' heaps per anchor and slot, with rank."""
    order = [F.col("score").desc(), F.col("vec_id").asc_nulls_last()]
    group = F.pmod(F.xxhash64("vec_id"), F.lit(MERGE_GROUPS))
    first = found.withColumn("group", group).withColumn("rank", F.row_number().over(Window.partitionBy("anchor", "slot", "group").orderBy(*order)))
    last = first.where(F.col("rank") <= k).withColumn("rank", F.row_number().over(Window.partitionBy("anchor", "slot").orderBy(*order)))
    return last.where(F.col("rank") <= k).select("anchor", "slot", "rank", "vec_id", "score")


def mine(rows: DataFrame, is_anchor: Column, vector: str = "embedding", positives: int = 5, negatives: int = 5,
         low: int = 80, high: int = 100, scale: float = 256.0, anchor_cells: int = ANCHOR_CELLS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score: for each anchor (rows where ``is_anchor`` holds, with an
    id) and each of its ``positives`` best rows of its label, the ``negatives``
    best rows of other labels with low * positive_score <= 100 *
    negative_score <= high * positive_score. ``rows`` needs vec_id, label
    and the vector column."""
    spark = rows.sparkSession
    kept = usable(rows, vector, scale)
    anchors = usable(rows.where(is_anchor), vector, scale).where("vec_id IS NOT NULL")
    out = None
    for block in row_blocks(anchors, F.size("vector") + 1, anchor_cells):
        width = max(len(r.vector) for r in block)
        own = Anchors([r.vec_id for r in block], [r.label for r in block], matrix([r.vector for r in block], width, scale), [])
        best = kept.mapInArrow(vertical_scan(spark.sparkContext.broadcast(own), positives, scale, best_of_label), FOUND_SCHEMA)
        chosen = materialize(merged(best, positives), "positives")
        # at most ``positives`` rows an anchor of the block
        slots: list[list] = [[] for _ in block]
        for r in chosen.orderBy("anchor", "rank").collect():
            slots[r.anchor].append(r)
        windows = [[(-(-low * r.score // 100), high * r.score // 100) for r in s] for s in slots]
        hard = kept.mapInArrow(vertical_scan(spark.sparkContext.broadcast(own._replace(windows=windows)), negatives, scale, best_in_windows), FOUND_SCHEMA)
        ids = spark.createDataFrame([(i, r.vec_id) for i, r in enumerate(block)], "anchor long, anchor_id long")
        named = chosen.select("anchor", (F.col("rank") - 1).cast("long").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")).join(ids, "anchor")
        one = merged(hard, negatives).join(named, ["anchor", "slot"]).select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        out = one if out is None else out.unionByName(one)
    if out is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return out
