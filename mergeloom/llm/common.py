"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.joins import join_bounded
from ..session import cut_lineage, new_path  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text column by name, null as empty."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def unused(df: DataFrame, name: str) -> str:
    """`name`, lengthened until no column of `df` has it."""
    while name in df.columns:
        name += "_"
    return name


def thinned(docs: DataFrame, key: Column, dropped: DataFrame, repeated: DataFrame) -> DataFrame:
    """Rows of `docs` whose key is not in `dropped`, and of those with a key in `repeated` one each.

    `key` is a struct; `dropped` and `repeated` have one column of such. Nulls in keys are equal to nulls.
    """
    own = unused(docs, "_own")
    keyed = docs.withColumn(own, key)
    other = unused(keyed, "_other")

    def met(df: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        return join_bounded(df, keys.toDF(other), df[own].eqNullSafe(F.col(other)), how)

    left = met(keyed, dropped, "left_anti")
    repeated = cut_lineage(repeated.toDF(other), "repeats")
    if repeated.isEmpty():
        return left.drop(own)
    once = met(left, repeated, "left_semi").dropDuplicates([own])
    return met(left, repeated, "left_anti").unionByName(once).drop(own)


def give_back() -> None:
    """Return freed memory to the system. Python workers outlive their tasks, and what one stage
    has freed would be missing to the next one's JVM."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
