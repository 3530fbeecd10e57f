from __future__ import annotations

import json
import os
import tempfile

import pytest

from corate.config import scratch_path
from corate.sources import files
from corate.sources.report_json import report_to_json, write_report_json
from tests.conftest import ratings_df


def _write(text: str) -> str:
    d = tempfile.mkdtemp(prefix="corate-src-")
    path = os.path.join(d, "input.txt")
    with open(path, "w") as f:
        f.write(text)
    return path


def test_tsv_reads_trimmed_fields_and_ignores_extra(spark):
    path = _write("1\t10\t4\t881250949\n 2 \t 20 \t 3.5 \n")
    rows = sorted(tuple(r) for r in files.read_ratings_tsv(spark, path).collect())
    assert rows == [(1, 10, 4.0), (2, 20, 3.5)]


def test_tsv_bad_line_fails(spark):
    path = _write("1\t10\t4\n2\tx\t3\n")
    with pytest.raises(Exception):
        files.read_ratings_tsv(spark, path).collect()


def test_tsv_round_trip(spark):
    df = ratings_df(spark, [(1, 2, 3), (4, 5, 1)])
    path = scratch_path(spark, "tsv-test")
    files.write_ratings_tsv(df, path)
    assert sorted(map(tuple, files.read_ratings_tsv(spark, path).collect())) == [(1, 2, 3.0), (4, 5, 1.0)]


def test_items_csv_quoted_title_and_empty_rating(spark):
    path = _write('1,Toy Story (1995),\n11,"Seven, The (1995)",3\n')
    rows = {r.item_id: r for r in files.read_items_csv(spark, path).collect()}
    assert rows[11].title == "Seven, The (1995)" and rows[11].rating == 3.0
    assert rows[1].rating is None


def test_items_csv_round_trip(spark):
    df = spark.createDataFrame([(1, 'A "quoted", title', None), (2, "plain", 5.0)],
                               "item_id bigint, title string, rating double")
    path = scratch_path(spark, "csv-test")
    files.write_items_csv(df, path)
    back = {r.item_id: (r.title, r.rating) for r in files.read_items_csv(spark, path).collect()}
    assert back == {1: ('A "quoted", title', None), 2: ("plain", 5.0)}


def test_report_json_nests_sections(spark):
    report = spark.createDataFrame(
        [("Q1", "Mae", 1.5), ("Q1", "Stats.min", 0.0), ("Q1", "Stats.max", 3.0), ("Q2", "Bytes", 8.0)],
        "section string, metric string, value double")
    doc = json.loads(report_to_json(report).first().json)
    assert doc == {"Q1": {"Mae": 1.5, "Stats": {"min": 0.0, "max": 3.0}}, "Q2": {"Bytes": 8.0}}
    path = scratch_path(spark, "report-test")
    write_report_json(report, path)
    text = spark.read.text(path).first().value
    assert json.loads(text) == doc


def test_report_json_lists_top_n(spark):
    report = spark.createDataFrame(
        [("Q3", "Top2", 2, 7, "b", 4.0), ("Q3", "Top2", 1, 9, "a", 4.5)],
        "section string, metric string, rank int, item_id bigint, title string, value double")
    doc = json.loads(report_to_json(report).first().json)
    assert doc == {"Q3": {"Top2": [{"item_id": 9, "title": "a", "value": 4.5},
                                   {"item_id": 7, "title": "b", "value": 4.0}]}}
