"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and is written as
Parquet before the next one reads it. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagetally.llm import decontamination, jaccard, language, packing, toxicity
from pagetally.llm.common import bounded_batches, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose language cannot be told: those without text or letters."""
    bounded_batches(spark)
    return language.identified(docs, language.fit(docs, ~language.held_out()))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that score as toxic."""
    bounded_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.clean(docs, toxicity.fit(docs, labels, ~toxicity.held_out()))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group that similar shingles connect."""
    bounded_batches(spark)
    return jaccard.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents in which a window of a benchmark item occurs."""
    bounded_batches(spark)
    return decontamination.decontaminated(
        docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places the remaining documents' tokens in sequences."""
    bounded_batches(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxicity_filter),
    ("jaccard_join", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Trained models and tokenizer ids cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
