"""Token shards as Parquet partitioned by split and shard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.packing import shard_lengths

_SCHEMA = "start bigint, doc_id bigint, tokens array<int>, n_tokens int, split string, shard_id int"
_MANIFEST = "split string, shard_id int, n_tokens bigint"


def _manifest_path(path: str) -> str:
    return path.rstrip("/") + "-manifest"


def write_shards(pieces: DataFrame, path: str) -> None:
    """One folder per shard, and a manifest of their lengths beside it. Rows arrive in ranges
    of doc_id, so a task writes only the few consecutive shards its range covers.

    The lengths are added up over what was written, from the pieces' lengths alone.
    """
    spark = pieces.sparkSession
    pieces.write.partitionBy("split", "shard_id").parquet(path)
    shard_lengths(read_shards(spark, path)).select("split", "shard_id", "n_tokens").write.parquet(_manifest_path(path))


def read_manifest(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """(split, shard_id, n_tokens) of the shards at `path`; no shard is read."""
    return _of_split(spark.read.schema(_MANIFEST).parquet(_manifest_path(path)), split)


def read_shards(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Shard pieces; a split is a partition filter, not a scan filter."""
    pieces = _of_split(spark.read.schema(_SCHEMA).parquet(path), split)
    return pieces.select("split", "shard_id", "start", "doc_id", "tokens", "n_tokens")


def _of_split(rows: DataFrame, split: str | None) -> DataFrame:
    if split is None:
        return rows
    if split not in ("train", "val"):
        raise ValueError(f"unknown split {split!r}")
    return rows.filter(F.col("split") == split)


def list_shards(pieces: DataFrame, prefix: str = "tokens") -> DataFrame:
    """(shard_id, split, name) in reading order; names sort like the ids."""
    name = F.format_string(prefix + "_%s_%06d", "split", "shard_id")
    return pieces.select("split", "shard_id").distinct().select(
        "shard_id", "split", name.alias("name")
    ).orderBy("shard_id")
