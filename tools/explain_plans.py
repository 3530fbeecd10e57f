"""Print the physical plan trees of the core operators as they run (what a
plan reads twice is written to the shared folder first).

    python tools/explain_plans.py /root/testdata/sf0.01
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

sys.path.insert(0, ".")
from corate.config import apply_conf  # noqa: E402
from corate.operators import capacity, evaluate, neighbors, pairs, predict  # noqa: E402
from corate.plans.context import TestdataContext  # noqa: E402


def tree(df) -> str:
    text = df._jdf.queryExecution().executedPlan().treeString()
    return "\n".join(line[:160] for line in text.splitlines())


def main() -> None:
    sf_dir = sys.argv[1]
    spark = apply_conf(SparkSession.builder.master("local[8]"), 16).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    c = TestdataContext(spark, sf_dir)
    ranked = neighbors.nearest_neighbors(c.cosine, 942)
    plans = {
        "co_rating_pairs": c.pairs,
        "predict (cosine) + mae": evaluate.mae(predict.predict(c.test_kept, c.profiles, c.means, c.cosine)),
        "nearest_neighbors (k=942)": ranked,
        "predict_knn sweep": predict.predict_knn(c.test_kept, c.profiles, c.means, ranked, evaluate.KNN_KS),
        "pair_overlap_stats": capacity.pair_overlap_stats(c.means, pairs.co_rated_counts(c.split_kept[0])),
    }
    for name, df in plans.items():
        print(f"===== {name}\n{tree(df)}\n")


if __name__ == "__main__":
    main()
