"""Corpus cleaning pipeline: five stages, each over all that its predecessor kept.

Every stage takes (spark, docs, sf_dir). All but the last return documents
with the columns they came with. Nulls, ties, repeated rows and empty tables
are handled as the operators' docstrings say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mergeloom.llm import decontaminate, exact_dedup, language_id, near_dedup, packing
from mergeloom.llm.common import cut_lineage, table
from mergeloom.session import ensure_work_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a language that the corpus's own labels teach."""
    return language_id.accepted(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs).drop("ids")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("exact_dedup", exact_duplicates),
    ("near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packed),
]

#: Naive Bayes, tokens and dynamic programming aren't SQL; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_work_dir(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
