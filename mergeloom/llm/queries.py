"""Registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import alignment, decontaminate, exact_dedup, html_extract, language_id, licences, near_dedup, packing, pii, quality, repair, token_output, toxicity
from .common import table

ORDER_KEY = 20240607


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).drop("ids")


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = token_output.write_shards(table(spark, sf_dir, "documents"), ORDER_KEY).records()
    return records.select("position", "shard", "byte_offset", F.crc32("ids").alias("ids_crc32"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.decide(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decide(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.decide(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.decide(table(spark, sf_dir, "documents"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.decide(table(spark, sf_dir, "documents"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.decide(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.decide(table(spark, sf_dir, "conversations"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.decide(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [
        op1_exact_dedup, op2_packing, op3_token_output, op4_pii, op5_decontamination,
        op6_html_text, op7_language_id, op8_toxicity, op9_licence_scan, op10_near_dedup,
        op11_quality, op12_conversation_repair, op13_token_alignment,
    ]
    return {f.__name__: f for f in named}
