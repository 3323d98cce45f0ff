"""Documents to training sequences: quality, near duplicates, personal data, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the documents of the next one. All but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmill.llm.common import store, table
from starmill.llm.mixing import mix
from starmill.llm.near_duplicates import one_of_each
from starmill.llm.packing import pack, public_tokenizer
from starmill.llm.pii import without_private
from starmill.llm.quality import assess_documents

MAX_REPEATS = 2.0


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior of being good is below the threshold go."""
    return assess_documents(spark, docs, sf_dir).filter("keep").select("row.*")


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return one_of_each(docs)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets become surrogates."""
    return without_private(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, and those of small sources up to twice as their weights ask."""
    return mix(docs, MAX_REPEATS).select("row.*")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in training sequences."""
    return pack(docs, public_tokenizer())


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("PII", private_data),
    ("source mixing", source_mixing),
    ("best-fit packing", best_fit_packing),
]

# learnt weights, MinHash and tokens: not for SQL; the tests hold each stage against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
