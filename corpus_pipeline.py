"""The corpus pipeline: toxic documents go, exact copies go, of each group
of near copies one stays, secrets are blotted out, and what is left is
packed into training sequences.

Every stage works on all rows that its predecessor kept. All but the last
return the columns of documents. Defined results: NULL texts pass as empty
ones; an empty table gives an empty result; columns beyond those of
documents are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corate.config import materialize
from corate.llm import exact_dedup, jaccard, packing, secrets, toxicity
from corate.llm.common import crc_fold, prepare, read_table
from corate.llm.queries import tokenizer_path

#: No SQL: classifiers, a tokenizer and a packing have no DuckDB statement.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity tagger (operator 5) doesn't reject. It
    learns from the labelled rows that operator 5's query learns from."""
    prepare(spark)
    labels = read_table(spark, sf_dir, "labels", "doc_id", "toxic")
    model = toxicity.fit_toxicity(docs.where(crc_fold("doc_id", 5) != 0), labels.where(crc_fold("doc_id", 5) != 0))
    return toxicity.drop_toxic(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each content (operator 4): the largest doc_id."""
    prepare(spark)
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links join (operator 2) at five-word
    shingles and a similarity of 0.8 or more: the smallest doc_id."""
    prepare(spark)
    return jaccard.keep_one(docs, words=5, percent=80)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret span (operator 1) replaced by a mark."""
    prepare(spark)
    return secrets.redact_secrets(docs, secrets.fit_markov(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences (operator 6)."""
    prepare(spark)
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scans", redact_secrets),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents; each stage's rows are written to the
    shared folder and read again, as later stages read them more than once."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
