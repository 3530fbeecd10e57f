from __future__ import annotations

import random
import re

import numpy as np
import pytest

from pyspark.sql import functions as F

from corate.llm import jaccard
from corate.llm.components import components

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text, k):
    words = WORD.findall((text or "").lower() if (text or "").isascii() else (text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) or frozenset([tuple(words)])


def brute(rows, k, percent):
    """All pairs, then components by repeated merging."""
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=repr)


def near_copies(seed, groups, copies, words):
    """Groups of texts that differ in a few words, with a shared passage."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=12)
    rows, n = [], 0
    for _ in range(groups):
        base = rng.choices(vocabulary, k=rng.randint(words // 2, words)) + passage
        for _ in range(rng.randint(1, copies)):
            text = list(base)
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((n, " ".join(text)))
            n += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "k", "percent"), [(1, 4, 85), (2, 5, 80), (3, 2, 60)])
def test_components_equal_brute_force(docs_df, seed, k, percent):
    rows = near_copies(seed, 25, 12, 120)
    got = jaccard.similar_components(docs_df(rows), k, percent).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, k, percent)


def test_chains_that_pivots_leave_open(docs_df):
    """A chain of sets, each near its neighbours only: links run between
    members of clusters whose pivots don't link."""
    words = [f"c{i}" for i in range(160)]
    rows = [(i, " ".join(words[2 * i : 2 * i + 60])) for i in range(48)]
    got = jaccard.similar_components(docs_df(rows), 4, 85).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, 4, 85)


def test_odd_rows(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = jaccard.similar_components(odd_docs, 4, 85).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, 4, 85)


@pytest.mark.parametrize("bits", [1, 5])
def test_different_sets_of_one_id(docs_df, bits):
    """So few bits of the first id are kept that nearly all sets share it."""
    rows = near_copies(4, 15, 8, 90)
    docs = docs_df(rows)
    got = jaccard.similar_components(docs, 4, 85, bits).select("doc_id", "n_shingles", "component_id").collect()
    want = brute(rows, 4, 85)
    assert sorted(map(tuple, got), key=repr) == want
    kept = {r.doc_id for r in jaccard.keep_one(docs, 4, 85, bits).collect()}
    assert kept == {component for _, _, component in want}


def test_keep_one_and_empty_table(odd_docs):
    kept = jaccard.keep_one(odd_docs.where("doc_id is not null"), 5, 80)
    assert kept.columns == odd_docs.columns
    assert sorted({r.doc_id for r in kept.collect()}) == [1, 2, 4, 6, 7, 9, 10]
    assert jaccard.similar_components(odd_docs.where("false")).count() == 0


def test_keep_one_with_null_and_repeated_ids(docs_df):
    """A row is kept or dropped for itself, not for its doc_id."""
    rng = random.Random(7)
    a, b, c, d, e = (" ".join(rng.choices([f"w{i}" for i in range(400)], k=60)) for _ in range(5))
    rows = [
        (1, a), (5, a + " more"), (5, b), (5, b + " tail"), (5, "  " + b),  # near copies of 1 and of each other under one id
        (None, c), (None, c + " end"), (None, d), (9, d + " x"),  # near copies without an id, and one with
        (7, e), (7, e), (7, e.replace(" ", "  ")), (7, None), (7, ""), (None, None),
    ]
    kept = jaccard.keep_one(docs_df(rows), 5, 80)
    got = [(r.doc_id, " ".join((r.text or "").split())) for r in kept.collect()]
    assert len(got) == 8 and kept.columns == docs_df(rows).columns
    assert sorted((i, t) for i, t in got if t and t[:50] not in (b[:50], c[:50])) == sorted([(1, a), (9, d + " x"), (7, e)])
    assert [i for i, t in got if t.startswith(b[:50])] == [5] and [i for i, t in got if t.startswith(c[:50])] == [None]
    assert sorted(repr(i) for i, t in got if not t) == ["7", "7", "None"]
    assert sorted(got, key=repr) == sorted([(r.doc_id, " ".join((r.text or "").split())) for r in jaccard.keep_one(docs_df(rows).repartition(5), 5, 80).collect()], key=repr)


def test_near_copy_stage_equals_brute_force(spark, docs_df):
    """The pipeline's stage, with its own parameters, on planted groups."""
    import corpus_pipeline

    rows = near_copies(11, 20, 8, 100)
    want = sorted({c for _, _, c in brute(rows, 5, 80)})
    assert len(want) < len(rows)
    kept = corpus_pipeline.drop_near_copies(spark, docs_df(rows), "")
    assert sorted(r.doc_id for r in kept.collect()) == want


def test_bitmap_bounds_the_difference():
    rng = np.random.default_rng(5)
    for _ in range(200):
        n, m = rng.integers(1, 300, 2)
        a, b = (np.unique(rng.integers(0, 500, size).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for size in (n, m))
        true = len(np.setxor1d(a, b))
        assert jaccard.least_difference(jaccard.parity_bitmap(a), jaccard.parity_bitmap(b)) <= true


def test_prefix_holds_a_common_token():
    for n in range(1, 300):
        need = -(-85 * n // 100)
        assert n - jaccard.prefix_length(n, 85) + 1 <= need


def test_components_of_a_path_a_star_and_a_loop(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(500, 500)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({got[i] for i in range(41)}) == 1
    assert len({got[i] for i in range(100, 130)}) == 1
    assert got[0] != got[100] and 500 not in got


def test_derived_answers_equal_intersections():
    """Members of two pivots: every overlap derived from the pivots' equals
    the overlap of the complete sets."""
    import numpy as np

    rng = random.Random(4)
    draw = lambda n: set(rng.sample(range(1, 400), n))
    pack = lambda s: np.array(sorted(s), np.uint64).tobytes()
    for _ in range(300):
        a, b = draw(rng.randint(1, 200)), draw(rng.randint(1, 200))
        x = (a - set(rng.sample(sorted(a), rng.randint(0, len(a) // 3)))) | draw(rng.randint(0, 9))
        y = (b - set(rng.sample(sorted(b), rng.randint(0, len(b) // 3)))) | draw(rng.randint(0, 9))
        row = (1, 2, len(a & b), pack(a - x), pack(x - a), len(x), pack(b))
        to_pivot = next(jaccard.derive_from_pivot(iter([_batch_of(row)])))
        assert to_pivot.column(2).to_pylist() == [len(x & b)] and to_pivot.column(3).to_pylist() == [len(x | b)]
        row = (1, 3, len(x & b), pack(a - x), pack(x - a), pack(b - y), pack(y - b), len(x), len(y), pack(a))
        between = next(jaccard.derive_members(iter([_batch_of(row)])))
        assert between.column(2).to_pylist() == [len(x & y)] and between.column(3).to_pylist() == [len(x | y)]


def _batch_of(row):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([v], pa.binary() if isinstance(v, bytes) else pa.int64()) for v in row], [f"c{i}" for i in range(len(row))])


def test_templates_that_link_nothing_make_no_pairs(spark, docs_df):
    """Pages of one template: all share a token of their prefixes, in a
    position that no index block has."""
    base = " ".join(f"template{i}" for i in range(20))
    docs = docs_df([(i, f"{base} own{i} more{i} last{i}") for i in range(300)])
    join = jaccard.JaccardJoin(docs, 4, 85)
    entries = join.entries.withColumns({"cluster": F.col("sid"), "distance": F.lit(0.0), "block": jaccard.size_block(F.col("n"), 85)})
    assert join.entries.count() >= 300 and join._cluster_pairs(entries).count() == 0


def test_hot_pivot_joins_can_be_split(docs_df, spark):
    """A pivot of very many copies: the join of the pairs with their bitmaps
    is dealt anew by AQE, which needs plain exchanges on both sides."""
    rng = random.Random(5)
    base = rng.choices([f"w{i}" for i in range(400)], k=200)
    rows = []
    for i in range(1500):
        text = list(base)
        text[rng.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(text)))
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        join = jaccard.JaccardJoin(docs_df(rows).repartition(8), 4, 85)
        pairs = join.rows.select(F.col("sid").alias("a"), F.lit(join.rows.agg(F.min("sid")).first()[0]).alias("b")).repartition(8).where("a <> b")
        bounded = pairs.join(join.bitmaps.select(F.col("sid").alias("b"), "bitmap"), "b")
        assert bounded.count() == 1499
        spread = bounded.withColumn("task", F.spark_partition_id()).groupBy("task").count().agg(F.max("count")).first()[0]
        plan = bounded._jdf.queryExecution().executedPlan().toString()
        assert spread < 1499, plan
        got = join.documents().agg(F.countDistinct("component_id"), F.count("*")).first()
        assert tuple(got) == (1, 1500)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
