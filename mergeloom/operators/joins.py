"""Joins with a side that is expected, but not assumed, to be small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import cut_lineage

BROADCAST_BYTES = 64 << 20


def _width(value: Column, kind: T.DataType) -> Column:
    """Approximate bytes of one value."""
    none = F.lit(16)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + none
    if isinstance(kind, T.ArrayType):
        add = lambda total, x: total + _width(x, kind.elementType).cast("bigint")
        return F.coalesce(F.aggregate(value, F.lit(0).cast("bigint"), add), F.lit(0)) + none
    if isinstance(kind, T.MapType):
        return _width(F.map_keys(value), T.ArrayType(kind.keyType)) + _width(F.map_values(value), T.ArrayType(kind.valueType))
    if isinstance(kind, T.StructType):
        return sum((_width(value.getField(f.name), f.dataType) for f in kind.fields), none)
    return none


def measured_bytes(df: DataFrame) -> int:
    total = sum((_width(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(0)).cast("bigint")
    return df.agg(F.coalesce(F.sum(total), F.lit(0))).first()[0]


def join_bounded(
    left: DataFrame, small: DataFrame, on: str | list[str] | Column, how: str = "inner",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Broadcast `small` if it measures at most `limit` bytes, else join by
    shuffle.

    `small` is stored first, so measuring it does not derive it twice.
    """
    stored = cut_lineage(small, "small-side")
    if measured_bytes(stored) <= limit:
        stored = F.broadcast(stored)
    return left.join(stored, on, how)


def join_back(rows: DataFrame, totals: DataFrame, key: str, salts: int = 16) -> DataFrame:
    """Rows with their key's totals (one row per key), as an inner join.

    Each key is split into `salts` parts by a hash of the whole row, and its totals
    are repeated for each, so a key with a third of all rows is many tasks' work.
    """
    part = F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int")
    repeated = totals.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("_part", part).join(repeated, [key, "_part"]).drop("_part")
