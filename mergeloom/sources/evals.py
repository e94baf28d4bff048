"""Evaluation examples as long rows, one per token position."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

EVAL_SCHEMA = "example_id bigint, cand_id int, pos int, loss double, mask int, label int"


def read_eval_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVAL_SCHEMA).parquet(path)
