"""A training corpus from ``documents``, in five stages.

Each stage takes what the one before kept, written as Parquet and read again,
and returns a DataFrame; all but the last return the columns of documents.

1. quality_rules: documents that fail the base rules or whose host is rejected go.
2. simhash_near_dedup: one document of each near-duplicate group stays.
3. benchmark_decontamination: documents with a benchmark passage go.
4. secret_scan: secrets are replaced by a placeholder; every document stays.
5. best_fit_packing: what is left, cut and packed into bins.

Rows with nulls, equal rows, empty and very long texts and empty tables are
treated as the operators state. SQL cannot express stage 2, so there is no
oracle; the tests hold the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelcast.llm.common import stored, table
from panelcast.llm.decontaminate import decontaminate
from panelcast.llm.packing import pack
from panelcast.llm.quality import apply_quality_rules
from panelcast.llm.secrets import redact
from panelcast.llm.simhash import keep_one


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return apply_quality_rules(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
