"""Documents to a training mix, stage by stage.

Every stage takes all rows its predecessor kept and returns the columns of documents; the
last one adds how often each document is taken. Null texts and empty tables pass through
every stage's defined case (see the operators).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, mixing, near_duplicates, pii, quality_rules
from tidemark.scratch import discard, keep

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    model = quality_rules.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_rules.keep_good(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies: five-word shingles, similarity 0.8."""
    return near_duplicates.keep_one_of_each(docs, width=5)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    masked = pii.mask_personal_data(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, with size, target and words taken."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "size", "source_size", "target", "taken"))
    mixed = mixing.mix_sources(docs, carry=others)
    return mixed.where("taken > 0").select("doc_id", *others, "size", "source_size", "target", "taken")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("near_duplicates", near_dedup),
    ("decontamination", decontaminate),
    ("personal_data", personal_data),
    ("mixing", mix),
]

#: A learned verdict, minhashes and alignments are beyond SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            discard(before)
        before = docs
    return docs
