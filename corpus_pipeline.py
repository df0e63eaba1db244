"""A training-corpus pipeline over documents: clean, deduplicate, mix, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; whoever runs the stages writes each
result as Parquet and reads it again as the next one's docs. All but the last return the columns
of documents, extra ones included, whatever their names.

A null text counts as empty. Of all empty texts one row stays after exact deduplication, and it is packed as one
token. Rows without doc_id pass as documents without a name: the exact stage keeps one only where no row of
its text has an id, the near stage leaves them, and their draws are alike. A null source is a source of its own. A row
repeated with its doc_id is the same document: one of them stays. Tables without rows give no rows, and without
labels of both classes nothing is toxic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridcube.llm import exact, minhash, mixing, packing, toxicity
from gridcube.llm.common import table
from gridcube.session import fresh_dir


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays."""
    return exact.without_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8 or more."""
    return minhash.without_near_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks for."""
    return mixing.emitted(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return packing.packed(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_stage),
    ("minhash_near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows: doc_id, piece and place of every piece of every document taken."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = fresh_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs


ORACLE_SQL = None
