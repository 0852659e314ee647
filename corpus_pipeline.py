"""Cleaning and packing of a document table, stage by stage.

Every stage takes (spark, docs, folder of the tables) and returns a DataFrame; it is written as Parquet and read back
as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from schoolzones.llm import decontaminate, mixing, quality_rules, simhash_dedup, token_files
from schoolzones.llm.queries import table, tokenizer
from schoolzones.llm.store import stored


def good_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash_dedup.keep_one(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold a benchmark item, or one made from it, go."""
    return decontaminate.without_leaks(docs, table(spark, folder, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document stays; those of smaller sources come again, until the weights have their tokens."""
    return mixing.repeat_rows(docs)


def token_ids(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The token files of all rows, as read back from them."""
    return token_files.encoded(docs, tokenizer())


STAGES = [
    ("quality rules", good_quality),
    ("SimHash near-dedup", one_of_each),
    ("benchmark decontamination", no_benchmark),
    ("mixing sources to target weights", mixed),
    ("token-ID / binary output", token_ids),
]

#: Fingerprint groups are a closure and the last stages pack and encode, which SQL can't express; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, folder), "stage-" + name.split()[0].lower())
    return docs
