"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the test tables (through the rating view) and runs over
all of them. Output doubles are rounded to 6 places (``rounded``) so they
compare with the DuckDB oracle in ``plans.oracle``; column names match it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corate.config import materialize, scratch_path
from corate.operators import (
    asked, capacity, checks, evaluate, incremental, moments, neighbors, overlaps, personal, ratings, recommend, topk)
from corate.operators import pairs as P
from corate.operators.blocks import tasks_for
from corate.operators.predict import predict, predict_from, predict_knn_from
from corate.plans import reports
from corate.plans.context import TestdataContext, rounded
from corate.sources import files, report_json, stored, testdata

Query = Callable[[SparkSession, str], DataFrame]

KNN_K = 30          # neighbours listed by knn_neighbors
KNN_PREDICT_K = 50  # neighbours used by predict_knn
LIST_K = 10         # neighbours per list in knn_lists
ALL_NEIGHBORS = 2**31 - 1
TOP_N = 5
RECOMMEND_KS = (30, 300)
BLOCK = 8           # rows per block in the *_blocked queries, so that items split
HEAVY = 32          # items beyond which co_rated_pairs_bitmap makes bitmaps
MANY_RATERS = 24    # raters beyond which pair_overlap_moments counts by items


def _ctx(spark: SparkSession, sf_dir: str) -> TestdataContext:
    return TestdataContext(spark, sf_dir)


def _joined(col: str) -> F.Column:
    return F.concat_ws(",", F.transform(F.col(col), lambda x: x.cast("string")))


# -- sources and checks ----------------------------------------------------

def src_ratings_tsv(spark, sf_dir):
    """The ratings through a file as other programs write it: a fourth field
    and blanks around the fields."""
    path = scratch_path(spark, "ratings-tsv")
    line = F.concat_ws("\t", F.concat(F.lit(" "), F.col("user_id")), F.concat("item_id", F.lit(" ")),
                       F.col("rating").cast("string"), F.lit("881250949"))
    testdata.ratings(spark, sf_dir).select(line.alias("value")).write.text(path)
    return files.read_ratings_tsv(spark, path)


def src_items_csv(spark, sf_dir):
    path = scratch_path(spark, "items-csv")
    files.write_items_csv(testdata.personal_catalogue(testdata.items(spark, sf_dir)), path)
    return files.read_items_csv(spark, path)


def check_row_count(spark, sf_dir):
    """The view's rows and those of its halves are counted by the tasks that
    write it; what they are compared with is counted on its own."""
    view, counts = checks.counted(
        testdata.ratings(spark, sf_dir, with_fold=True), "ratings", rows=F.count(F.lit(1)),
        test=F.count_if(F.col("fold") == 0), train=F.count_if(F.col("fold") != 0))
    raw_keys = testdata.raw_ratings(spark, sf_dir).select("user_id", "item_id").distinct()
    keys = raw_keys.agg(F.count(F.lit(1)).alias("expected"))
    rows = F.lit(counts["rows"]).cast("long")
    return checks.combine([
        keys.select(F.lit("ratings_rows").alias("check"), "expected", rows.alias("actual"),
                    (F.col("expected") == rows).alias("ok")),
        checks.unique_key_check("ratings_duplicate_keys", view),
        checks.known_count_check("split_rows", view, counts["train"] + counts["test"], counts["rows"]),
    ])


# -- ratings ---------------------------------------------------------------

def user_item_sets(spark, sf_dir):
    sets = ratings.item_sets(_ctx(spark, sf_dir).train)
    return sets.select("user_id", "page", "size", _joined("items").alias("items"))


def item_user_sets(spark, sf_dir):
    sets = ratings.rater_sets(_ctx(spark, sf_dir).train)
    return sets.select("item_id", "page", "size", _joined("users").alias("users"))


def user_mean(spark, sf_dir):
    return rounded(ratings.user_means(_ctx(spark, sf_dir).train))


def normalized_deviation(spark, sf_dir):
    train = _ctx(spark, sf_dir).split_kept[0]
    return rounded(ratings.normalize(train).select("user_id", "item_id", "rating", "mean", "dev"))


def user_norm(spark, sf_dir):
    return rounded(ratings.user_stats(_ctx(spark, sf_dir).train).select("user_id", "norm"))


def unit_weights(spark, sf_dir):
    return rounded(ratings.normalize(_ctx(spark, sf_dir).split_kept[0]).select("user_id", "item_id", "w"))


# -- similarity ------------------------------------------------------------

def co_rated_pairs(spark, sf_dir):
    return P.co_rated_counts(_ctx(spark, sf_dir).split_kept[0])


def sim_cosine(spark, sf_dir):
    return rounded(_ctx(spark, sf_dir).cosine)


def _rounded_cosine(pairs: DataFrame) -> DataFrame:
    """The similarities as they are returned: rounded before they are written,
    they take fewer bytes."""
    return rounded(P.cosine(pairs))


def sim_cosine_blocked(spark, sf_dir):
    """The similarities with every item of more than BLOCK raters split."""
    c = _ctx(spark, sf_dir)
    return P.written_pairs(c.profiles, _rounded_cosine, "similarities", BLOCK, load=c.load)


def co_rated_pairs_bitmap(spark, sf_dir):
    """The overlaps with users of more than HEAVY items as bitmaps."""
    return overlaps.bitmap_overlaps(_ctx(spark, sf_dir).split_kept[0], HEAVY)


def sim_cosine_stored(spark, sf_dir):
    """The similarities over tables stored by user and by item."""
    train = stored.by_key(_ctx(spark, sf_dir).train, "ratings", "user_id")
    load = P.pair_load(train)
    # a bucket is a task of the pair join
    profiles = stored.by_key(ratings.normalize(train), "profiles", "item_id", tasks_for(spark, load.rows))
    return P.written_pairs(profiles, _rounded_cosine, "similarities", dealt=True, load=load)


def sim_after_append(spark, sf_dir):
    """The similarities of a stored pair table after the personal ratings are
    appended: only pairs of users that they touch are computed."""
    c = _ctx(spark, sf_dir)
    known = materialize(c.ratings, "ratings")
    base = incremental.build(known)
    sims = P.written_pairs(base.profiles, P.cosine, "similarities", always=True)
    batch = _personal_batch(known, testdata.personal_catalogue(c.items))
    model, touched = incremental.append(base, batch)
    return rounded(incremental.append_similarities(sims, model, touched))


def sim_symmetric(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return P.symmetric(P.written_pairs(c.profiles, _rounded_cosine, "similarities", load=c.load))


def sim_jaccard(spark, sf_dir):
    return rounded(_ctx(spark, sf_dir).jaccard)


# -- prediction ------------------------------------------------------------

def _predict(measure: str, distinct: bool) -> Query:
    def run(spark, sf_dir):
        c = _ctx(spark, sf_dir)
        out = predict_from(c.test_kept.select("user_id", "item_id"), c.profiles, c.means, {"pred": measure},
                           distinct_terms=distinct, load=c.load)
        return rounded(out)
    run.__name__ = f"predict_{measure}{'_distinct' if distinct else ''}"
    return run


def predict_cosine_blocked(spark, sf_dir):
    """The predictions with items split into blocks of BLOCK rows."""
    c = _ctx(spark, sf_dir)
    return rounded(predict_from(c.test_kept.select("user_id", "item_id"), c.profiles, c.means, {"pred": "cosine"},
                                block_size=BLOCK, load=c.load))


def predict_cosine_asked(spark, sf_dir):
    """The predictions from the similarities that the targets ask for."""
    c = _ctx(spark, sf_dir)
    keys = c.test_kept.select("user_id", "item_id")
    # written, so that what was shuffled for them is gone before candidates are
    sims = materialize(P.cosine(asked.asked_pairs(keys, c.profiles)), "similarities")
    return rounded(predict(keys, c.profiles, c.means, sims, tasks=c.tasks))


def predict_jaccard_self(spark, sf_dir):
    """Jaccard predictions of train and test keys, own ratings included."""
    c = _ctx(spark, sf_dir)
    keys = c.split_kept[0].unionByName(c.test_kept).select("user_id", "item_id")
    return rounded(predict_from(keys, c.profiles, c.means, {"pred": "jaccard"}, include_self=True, load=c.load))


def predict_knn_query(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    out = predict_knn_from(c.test_kept.select("user_id", "item_id"), c.profiles, c.means,
                           [KNN_PREDICT_K], load=c.load)
    return rounded(out.select("user_id", "item_id", F.col(f"pred_{KNN_PREDICT_K}").alias("pred")))


# -- neighbours ------------------------------------------------------------

def knn_neighbors(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return rounded(neighbors.cosine_neighbors(c.profiles, KNN_K, load=c.load))


def knn_neighbors_near(spark, sf_dir):
    """The same lists without aggregating every pair."""
    return rounded(topk.top_neighbors(_ctx(spark, sf_dir).profiles, KNN_K))


def knn_neighbors_half(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return rounded(neighbors.cosine_neighbors(c.profiles, KNN_K, symmetric=False, load=c.load))


def knn_lists(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    lists = neighbors.neighbor_lists(neighbors.cosine_neighbors(c.profiles, LIST_K, load=c.load))
    ids = F.transform(F.col("neighbors"), lambda r: r["neighbor_id"].cast("string"))
    return lists.select("user_id", F.concat_ws(",", ids).alias("neighbors"))


# -- evaluation ------------------------------------------------------------

def _test_predictions(c: TestdataContext, measure: str) -> DataFrame:
    return predict_from(c.test_kept, c.profiles, c.means, {"pred": measure}, load=c.load)


def mae_repeated_targets(spark, sf_dir):
    """MAE over the test lines before they are made unique: a key that was
    ordered several times is several rows, each with its own rating."""
    c = _ctx(spark, sf_dir)
    lines = testdata.raw_ratings(spark, sf_dir).where(testdata.fold() == 0)
    preds = predict_from(lines, c.profiles, c.means, {"pred": "cosine"}, load=c.load)
    return rounded(preds.agg(F.count(F.lit(1)).alias("n_rows"),
                             F.avg(F.abs(F.col("rating") - F.col("pred"))).alias("mae")))


def mae_cosine(spark, sf_dir):
    return rounded(evaluate.mae(_test_predictions(_ctx(spark, sf_dir), "cosine")))


def mae_jaccard(spark, sf_dir):
    return rounded(evaluate.mae(_test_predictions(_ctx(spark, sf_dir), "jaccard")))


def _both_maes(c: TestdataContext) -> DataFrame:
    measures = {"pred_cosine": "cosine", "pred_jaccard": "jaccard"}
    preds = predict_from(c.test_kept, c.profiles, c.means, measures, load=c.load)
    return evaluate.mae_columns(preds, {"cosine": "pred_cosine", "jaccard": "pred_jaccard"})


def mae_comparison(spark, sf_dir):
    return rounded(evaluate.mae_comparison("cosine", "jaccard", _both_maes(_ctx(spark, sf_dir))))


def _by_k(c: TestdataContext, ks: Sequence[int]) -> DataFrame:
    preds = predict_knn_from(c.test_kept, c.profiles, c.means, ks, load=c.load)
    return evaluate.mae_by_k(preds, ks)


def mae_knn_by_k(spark, sf_dir):
    return rounded(_by_k(_ctx(spark, sf_dir), evaluate.KNN_KS))


def lowest_k(spark, sf_dir):
    """The MAE of the cosine prediction is that of the k that no user's
    neighbours exceed, so one pass gives it beside the others."""
    every = materialize(_by_k(_ctx(spark, sf_dir), [*evaluate.KNN_KS, ALL_NEIGHBORS]), "by-k")
    by_k = every.where(F.col("k") != ALL_NEIGHBORS)
    cosine_mae = every.where(F.col("k") == ALL_NEIGHBORS).select("mae").scalar()
    rows = [evaluate.lowest_k(by_k, evaluate.BASELINE_MAE).select(
                F.lit("reference").alias("baseline_name"),
                F.lit(evaluate.BASELINE_MAE).alias("baseline"), "*"),
            evaluate.lowest_k(by_k, cosine_mae).select(
                F.lit("cosine").alias("baseline_name"), cosine_mae.alias("baseline"), "*")]
    return rounded(rows[0].unionByName(rows[1]))


# -- cost and capacity -----------------------------------------------------

def _overlap(spark, sf_dir) -> DataFrame:
    train = _ctx(spark, sf_dir).split_kept[0]
    return capacity.pair_overlap_stats(_user_counts(train), P.co_rated_counts(train))


def _user_counts(train: DataFrame) -> DataFrame:
    return train.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_items"))


def pair_overlap_stats(spark, sf_dir):
    return rounded(_overlap(spark, sf_dir))


def pair_overlap_moments(spark, sf_dir):
    """Mean and deviation of all overlaps, the pairs of items of more than
    MANY_RATERS raters never formed."""
    return rounded(moments.overlap_moments(_ctx(spark, sf_dir).train, MANY_RATERS))


def similarity_cost(spark, sf_dir):
    return capacity.similarity_cost(_user_counts(_ctx(spark, sf_dir).train))


def similarity_storage(spark, sf_dir):
    return capacity.similarity_storage(_overlap(spark, sf_dir))


def knn_storage(spark, sf_dir):
    return capacity.knn_storage(_user_counts(_ctx(spark, sf_dir).train))


def knn_capacity(spark, sf_dir):
    return capacity.knn_capacity(_user_counts(_ctx(spark, sf_dir).train))


def summary_stats(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    return rounded(evaluate.summary_stats(events, "value", ["event_type"]))


# -- recommendation --------------------------------------------------------

def recommend_topn(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    rated = materialize(c.ratings, "ratings")
    return rounded(recommend.recommend(rated, c.items, None, k=KNN_K, n=TOP_N))


def _personal(spark, sf_dir, catalogue: DataFrame | None = None):
    c = _ctx(spark, sf_dir)
    mine = testdata.personal_catalogue(c.items) if catalogue is None else catalogue
    known = materialize(c.ratings, "ratings")
    rated, _ = personal.append_personal(known, mine)
    users = known.agg((F.max("user_id") + 1).alias("user_id"))
    return c, rated, users


def _personal_batch(known: DataFrame, mine: DataFrame) -> DataFrame:
    """The personal user's ratings as a batch for ``incremental.append``."""
    return materialize(personal.personal_ratings(mine, personal.new_user_id(known)), "batch")


def recommend_personal(spark, sf_dir):
    c, rated, users = _personal(spark, sf_dir)
    recs = recommend.recommend_many(rated, c.items, users, RECOMMEND_KS, TOP_N)
    return rounded(recs.select("k", "rank", "item_id", "title", "pred"))


def _personal_file(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "personal-csv")
    files.write_items_csv(testdata.personal_catalogue(testdata.items(spark, sf_dir)), path)
    return files.read_items_csv(spark, path)


def recommend_from_csv(spark, sf_dir):
    """The third program's main path: a personal CSV file, checked and
    appended to a model of the known ratings, then the top n per k."""
    mine = _personal_file(spark, sf_dir)
    checks.assert_checks(personal.personal_checks(mine))
    known = materialize(_ctx(spark, sf_dir).ratings, "ratings")
    model, users = incremental.append(incremental.build(known), _personal_batch(known, mine))
    recs = recommend.recommend_many(model.ratings, mine.select("item_id", "title"), users, RECOMMEND_KS, TOP_N,
                                    model=model)
    return rounded(recs.select("k", "rank", "item_id", "title", "pred"))


def check_personal(spark, sf_dir):
    """Check rows of the personal ratings, doubled where the item id is a
    multiple of 64 so that some lie outside the scale."""
    mine = testdata.personal_catalogue(testdata.items(spark, sf_dir))
    odd = mine.withColumn("rating", F.when(F.col("item_id") % 64 == 0, F.col("rating") * 2).otherwise(F.col("rating")))
    return personal.personal_checks(odd)


# -- reports ---------------------------------------------------------------

def report_similarity(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return rounded(reports.similarity_report(*c.split_kept))


def report_knn(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return rounded(reports.knn_report(*c.split_kept))


def report_recommend(spark, sf_dir):
    c, rated, users = _personal(spark, sf_dir)
    return rounded(reports.recommend_report(rated, c.items, users, RECOMMEND_KS, TOP_N))


def report_similarity_json(spark, sf_dir):
    """The fields of the similarity report as its JSON text states them."""
    return _fields(report_similarity(spark, sf_dir))


def report_knn_json(spark, sf_dir):
    return _fields(report_knn(spark, sf_dir))


def report_recommend_json(spark, sf_dir):
    """The entries of the recommendation report's JSON lists."""
    text = report_json.report_to_json(report_recommend(spark, sf_dir))
    parsed = text.select(F.from_json("json", "map<string,map<string,array<struct<item_id:bigint,title:string,value:double>>>>").alias("j"))
    lists = parsed.select(F.explode("j").alias("section", "m")).select("section", F.explode("m").alias("metric", "rows"))
    return lists.select("section", "metric", F.posexplode("rows").alias("at", "r")).select(
        "section", "metric", (F.col("at") + 1).cast("long").alias("rank"), "r.item_id", "r.title", "r.value")


def _fields(report: DataFrame) -> DataFrame:
    """``(section, metric, value, whole)`` parsed back from the JSON text;
    ``whole`` tells whether the number stands there without a fraction."""
    text = report_json.report_to_json(report, reports.WHOLE_METRICS)
    sections = text.select(F.explode(F.from_json("json", "map<string,map<string,string>>")).alias("section", "m"))
    flat = sections.select("section", F.explode("m").alias("metric", "raw"))
    nested = flat.where(F.startswith("raw", F.lit("{"))).select(
        "section", "metric", F.explode(F.from_json("raw", "map<string,string>")).alias("sub", "raw"))
    rows = flat.where(~F.startswith("raw", F.lit("{"))).unionByName(
        nested.select("section", F.concat_ws(".", "metric", "sub").alias("metric"), "raw"))
    return rows.select("section", "metric", F.col("raw").cast("double").alias("value"),
                       (~F.col("raw").rlike("[.eE]")).alias("whole"))


QUERIES: dict[str, Query] = {
    "src_ratings_tsv": src_ratings_tsv,
    "src_items_csv": src_items_csv,
    "check_row_count": check_row_count,
    "user_item_sets": user_item_sets,
    "item_user_sets": item_user_sets,
    "user_mean": user_mean,
    "normalized_deviation": normalized_deviation,
    "user_norm": user_norm,
    "unit_weights": unit_weights,
    "co_rated_pairs": co_rated_pairs,
    "co_rated_pairs_bitmap": co_rated_pairs_bitmap,
    "sim_cosine": sim_cosine,
    "sim_cosine_stored": sim_cosine_stored,
    "sim_after_append": sim_after_append,
    "sim_cosine_blocked": sim_cosine_blocked,
    "sim_symmetric": sim_symmetric,
    "sim_jaccard": sim_jaccard,
    "predict_cosine": _predict("cosine", False),
    "predict_cosine_distinct": _predict("cosine", True),
    "predict_jaccard": _predict("jaccard", False),
    "predict_jaccard_distinct": _predict("jaccard", True),
    "predict_cosine_blocked": predict_cosine_blocked,
    "predict_cosine_asked": predict_cosine_asked,
    "predict_jaccard_self": predict_jaccard_self,
    "predict_knn": predict_knn_query,
    "knn_neighbors": knn_neighbors,
    "knn_neighbors_near": knn_neighbors_near,
    "knn_neighbors_half": knn_neighbors_half,
    "knn_lists": knn_lists,
    "mae_cosine": mae_cosine,
    "mae_jaccard": mae_jaccard,
    "mae_repeated_targets": mae_repeated_targets,
    "mae_comparison": mae_comparison,
    "mae_knn_by_k": mae_knn_by_k,
    "lowest_k": lowest_k,
    "pair_overlap_stats": pair_overlap_stats,
    "pair_overlap_moments": pair_overlap_moments,
    "similarity_cost": similarity_cost,
    "similarity_storage": similarity_storage,
    "knn_storage": knn_storage,
    "knn_capacity": knn_capacity,
    "summary_stats": summary_stats,
    "recommend_topn": recommend_topn,
    "recommend_personal": recommend_personal,
    "recommend_from_csv": recommend_from_csv,
    "check_personal": check_personal,
    "report_similarity": report_similarity,
    "report_knn": report_knn,
    "report_recommend": report_recommend,
    "report_similarity_json": report_similarity_json,
    "report_knn_json": report_knn_json,
    "report_recommend_json": report_recommend_json,
}
