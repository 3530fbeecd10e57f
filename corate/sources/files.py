"""Readers and writers for the reference's text inputs.

``ratings`` files are tab-separated lines ``user<TAB>item<TAB>rating[...]``
without a header; fields are trimmed and any past the third are ignored. A
line whose first three fields do not parse fails the read.

``items`` files are comma-separated lines ``item,title,rating`` without a
header; the rating may be empty (NULL) and titles may be quoted, with
commas inside the quotes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _all_valid(rows: DataFrame, valid, message) -> DataFrame:
    """``rows``, failing on the first that isn't ``valid``.

    The test is a filter, so it runs over every row whatever columns the
    caller reads, ``count()`` included; a test inside a column would be
    pruned with the column.
    """
    return rows.where(F.when(valid, F.lit(True)).otherwise(
        F.raise_error(message).cast("boolean")))


def read_ratings_tsv(spark: SparkSession, path: str) -> DataFrame:
    """``(user_id BIGINT, item_id BIGINT, rating DOUBLE)`` from tab-separated text."""
    parts = F.split(F.col("value"), "\t")
    kinds = {"user_id": "bigint", "item_id": "bigint", "rating": "double"}
    values = {name: F.trim(F.try_element_at(parts, F.lit(i + 1))).try_cast(kind)
              for i, (name, kind) in enumerate(kinds.items())}
    valid = F.lit(True)
    for value in values.values():
        valid = valid & value.isNotNull()
    lines = _all_valid(spark.read.text(path), valid,
                       F.concat(F.lit("bad ratings line: "), F.col("value")))
    return lines.select(*[value.alias(name) for name, value in values.items()])


def write_ratings_tsv(ratings: DataFrame, path: str) -> None:
    """Write ``(user_id, item_id, rating)`` as tab-separated text."""
    (ratings.select("user_id", "item_id", "rating")
     .write.mode("error").option("sep", "\t").option("header", "false").csv(path))


def read_items_csv(spark: SparkSession, path: str) -> DataFrame:
    """``(item_id, title, rating)`` from comma-separated text.

    Fails on a line without three fields, without an item id or with a
    rating that is no number, whatever columns are read: fields are read as
    text, and the test needs all of them.
    """
    lines = (spark.read.schema("item_id string, title string, rating string, _line string")
             .option("header", "false").option("mode", "PERMISSIVE")
             .option("columnNameOfCorruptRecord", "_line").option("columnPruning", "false")
             .option("quote", '"').option("escape", '"')
             .csv(path))
    item, rating = F.trim("item_id").try_cast("bigint"), F.trim("rating").try_cast("double")
    valid = (F.col("_line").isNull() & item.isNotNull()
             & (F.col("rating").isNull() | rating.isNotNull()))
    message = F.concat(F.lit("bad items line: "), F.coalesce(
        F.col("_line"), F.concat_ws(",", "item_id", "title", "rating")))
    return _all_valid(lines, valid, message).select(
        item.alias("item_id"), "title", rating.alias("rating"))


def write_items_csv(items: DataFrame, path: str) -> None:
    """Write ``(item_id, title, rating)``; NULL ratings become empty fields."""
    (items.select("item_id", "title", "rating")
     .write.mode("error").option("header", "false")
     .option("quote", '"').option("escape", '"').option("nullValue", "")
     .csv(path))
