"""The corpus pipeline: quality, exact copies, near copies, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it has kept, and returns the documents that stay,
with the columns of ``documents``; the last one returns packed pieces. Each result is written as Parquet and read again.
An empty table passes through all stages. Nulls, repeats and long texts are handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logtally.llm.decontamination import drop_contaminated
from logtally.llm.exact_dedup import drop_copies
from logtally.llm.ngram_join import keep_one
from logtally.llm.packing import pack_documents
from logtally.llm.quality import keep_good
from logtally.llm.tables import saved


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the largest id stays."""
    return drop_copies(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the one with the smallest id stays."""
    return keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed windows."""
    return pack_documents(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", packing),
]

#: The first stage is a learned model; the tests compare the others with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
