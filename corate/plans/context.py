"""Shared intermediates of the registered queries over the test tables.

A ``TestdataContext`` builds each DataFrame on first use. What a query reads
several times is written once to the shared folder.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corate.config import materialize
from corate.functions import round_half_away
from corate.operators import pairs as P
from corate.operators.blocks import tasks_for
from corate.operators.ratings import normalize, user_stats
from corate.sources import testdata

# Decimal places of every DOUBLE in a registered query's output, so that
# results of engines that sum in different orders compare equal.
OUTPUT_DIGITS = 6


def rounded(df: DataFrame, digits: int = OUTPUT_DIGITS) -> DataFrame:
    """Round every DOUBLE column of ``df``."""
    cols: list[Column] = []
    for field in df.schema.fields:
        if field.dataType.typeName() == "double":
            cols.append(round_half_away(field.name, digits).alias(field.name))
        else:
            cols.append(F.col(field.name))
    return df.select(*cols)


class TestdataContext:
    """Rating view, split and model intermediates for one scale factor.

    ``ratings``, ``train`` and ``test`` are plans over the tables: a query
    that reads one of them once runs nothing before its action. The model's
    intermediates are read by several branches (test rows, the pair join and
    the candidate join), so ``split_kept`` writes the rating view once, and
    ``profiles`` is a table of which each reader takes the columns it needs.
    """

    __test__ = False  # not a pytest test class

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def ratings(self) -> DataFrame:
        return testdata.ratings(self.spark, self.sf_dir)

    @cached_property
    def _split(self) -> tuple[DataFrame, DataFrame]:
        return testdata.split(testdata.ratings(self.spark, self.sf_dir, with_fold=True))

    @cached_property
    def train(self) -> DataFrame:
        return self._split[0]

    @cached_property
    def test(self) -> DataFrame:
        return self._split[1]

    @cached_property
    def split_kept(self) -> tuple[DataFrame, DataFrame]:
        """``(train, test)`` of the rating view, written once."""
        view = testdata.ratings(self.spark, self.sf_dir, with_fold=True)
        return testdata.split(materialize(view, "ratings"))

    @cached_property
    def test_kept(self) -> DataFrame:
        return self.split_kept[1]

    @cached_property
    def stats(self) -> DataFrame:
        return materialize(user_stats(self.split_kept[0]), "stats")

    @cached_property
    def means(self) -> DataFrame:
        return self.stats.select("user_id", "mean", "n_items")

    @cached_property
    def profiles(self) -> DataFrame:
        return materialize(normalize(self.split_kept[0], self.stats), "profiles")

    @cached_property
    def load(self) -> P.Load:
        return P.pair_load(self.profiles)

    @cached_property
    def tasks(self) -> int:
        return tasks_for(self.spark, self.load.rows)

    @cached_property
    def pairs(self) -> DataFrame:
        return P.co_rating_pairs(self.profiles, load=self.load)

    @cached_property
    def cosine(self) -> DataFrame:
        return P.cosine(self.pairs)

    @cached_property
    def jaccard(self) -> DataFrame:
        return P.jaccard_pairs(self.pairs)

    @cached_property
    def items(self) -> DataFrame:
        return testdata.items(self.spark, self.sf_dir)
