"""From raw documents to token files: five stages, each written as Parquet and read again by the next.

``run(spark, sf_dir)`` returns what the last stage reads back from the token files. Every stage works on all rows
its predecessor kept. A failed run can be started again from the folder of any stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from waymark.llm import decontamination, minhash_forest, mixing, quality_rules
from waymark.llm.queries import write_and_read_tokens
from waymark.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules, or whose host does, go."""
    return quality_rules.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity 0.8 or more."""
    return minhash_forest.drop_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target words; a document may occur up to three times."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mixed documents; one row per document read back from them."""
    return write_and_read_tokens(spark, docs)


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("source mixing", mix_sources),
    ("token files", tokens),
]

# The tokenizer has no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
