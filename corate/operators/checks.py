"""Row-count and uniqueness checks that return rows instead of raising.

A check row is ``(check, expected, actual, ok)``. Expected counts may be
numbers (like a known file size) or another DataFrame whose row count is
the expectation; both sides are counted in one aggregation, without
bringing either to the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from corate.config import materialize
from corate.operators.ratings import duplicate_keys


def count_check(name: str, actual: DataFrame, expected: int | DataFrame) -> DataFrame:
    """One check row comparing ``actual``'s row count with ``expected``."""
    tagged = actual.select(F.lit(1).alias("a"), F.lit(0).alias("e"))
    if isinstance(expected, DataFrame):
        tagged = tagged.unionByName(expected.select(F.lit(0).alias("a"), F.lit(1).alias("e")))
        exp = F.sum("e").cast("long")
    else:
        exp = F.lit(int(expected)).cast("long")
    row = tagged.agg(exp.alias("expected"), F.sum("a").cast("long").alias("actual"))
    return row.select(F.lit(name).alias("check"),
                      "expected",
                      F.coalesce(F.col("actual"), F.lit(0).cast("long")).alias("actual")
                      ).withColumn("ok", F.col("expected") == F.col("actual"))


def counted(df: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """``df`` written to the shared folder, and the ``counts`` (aggregates)
    of its rows, taken by the tasks that write it: no scan of their own."""
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    table = materialize(df.observe(seen, *[c.alias(n) for n, c in counts.items()]), name)
    return table, {n: int(v or 0) for n, v in seen.get.items()}


def known_count_check(name: str, like: DataFrame, actual: int, expected: int) -> DataFrame:
    """A check row of counts that are known (see ``counted``); ``like`` gives
    the session."""
    return like.sparkSession.createDataFrame(
        [(name, expected, actual, expected == actual)], "check string, expected long, actual long, ok boolean")


def unique_key_check(name: str, ratings: DataFrame) -> DataFrame:
    """Check row: number of ``(user_id, item_id)`` keys occurring twice or more is 0."""
    return count_check(name, duplicate_keys(ratings), 0)


def combine(checks: Sequence[DataFrame]) -> DataFrame:
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def assert_checks(checks: DataFrame) -> None:
    """Raise if any check row is not ok, naming every one (an action).

    The failing rows are joined into one text by Spark; there is a row per
    check, so they are few by nature.
    """
    text = F.concat(F.col("check"), F.lit(" expected "), F.col("expected").cast("string"),
                    F.lit(" got "), F.col("actual").cast("string"))
    failed = checks.where(~F.col("ok")).agg(
        F.concat_ws(", ", F.array_sort(F.collect_list(text))).alias("failed")).first().failed
    if failed:
        raise AssertionError(f"failed checks: {failed}")
