"""From raw documents to token files: quality, near-duplicates, contamination, mixing, token ids.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept; all but the last return
the columns of ``documents``. A stage's result is written as Parquet to the folder named by
``spark.checkpoint.dir`` and read again, so a lost executor costs the tasks it ran and no earlier stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from snowloom.llm import decontaminate, mixing, quality, simhash, token_files
from snowloom.llm.registry import prepare
from snowloom.session import materialize

# No stage before the last has a result that SQL can express: the first is a trained model.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled neighbours do not vote down."""
    return quality.keep_good(docs, prepare(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    prepare(spark)
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark item."""
    return decontaminate.keep_clean(docs, prepare(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks for."""
    prepare(spark)
    return mixing.repeated(mixing.mix(docs))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; one row per document in them, read back."""
    prepare(spark)
    return token_files.encode(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mixing),
    ("token-ID / binary output", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns what the last one returns."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
