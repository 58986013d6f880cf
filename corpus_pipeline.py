"""Corpus pipeline: quality, line dedup, near-duplicates, decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its
predecessor kept; all but the last return the columns of ``documents``.
``run`` writes each stage as Parquet under the cluster's shared checkpoint
folder and reads it back, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loadcast.llm import decontaminate, lines, packing, quality, simhash
from loadcast.llm.common import table, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within their language's threshold."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines go, except in the document that keeps them."""
    return lines.drop_recurring(docs)


def simhash_neardup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs, k=simhash.SHINGLE, max_bits=simhash.MAX_BITS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are mostly such go."""
    return decontaminate.remove_hits(docs, table(spark, sf_dir, "benchmark"))


def bestfit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Placement of every piece of every document in a training sequence."""
    return packing.packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("simhash_neardup", simhash_neardup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bestfit_packing", bestfit_packing),
]

#: Perplexities, fingerprints and token ids have no SQL form; tests/llm compare
#: the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
