"""A corpus pipeline of five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trackmill.llm import decontaminate, mixing, near_dedup, outliers, pii
from trackmill.llm.work import Scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return outliers.passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays; five words a shingle, similarity 0.8."""
    return near_dedup.first_of_groups(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts give way to surrogates."""
    return pii.with_surrogates(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, as often as it takes them."""
    return mixing.mixture(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near-dedup", near_duplicates),
    ("decontamination", decontamination),
    ("personal data", personal_data),
    ("source mix", source_mix),
]

#: SQL can't express the fitted estimates, the surrogates and the sampling.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after the other, over `documents`."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = scratch.settle(docs, name.replace(" ", "-"))
    return docs
