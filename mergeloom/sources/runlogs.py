"""Run-log files: space-separated text lines and CSV tables per run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .paths import partition_value, plain_path

TRAIN_LOG_SCHEMA = (
    "step bigint, train_loss double, lr double, grad_norm double, tps double, "
    "elapsed_seconds double, wall_elapsed_seconds double, "
    "non_training_time_this_step double, total_non_training_time double, "
    "mem_allocation double, gpu_mem_reserved_mb double, gpu_peak_vram_mb double, "
    "gpu_utilization_pct double, gpu_power_watts double, gpu_memory_used_mb double, "
    "gpu_memory_total_mb double"
)
VAL_LOG_SCHEMA = (
    "step bigint, val_loss double, val_perplexity double, elapsed_seconds double, "
    "wall_elapsed_seconds double, non_training_time_this_step double, "
    "total_non_training_time double, mem_allocation double, gpu_mem_reserved_mb double, "
    "gpu_peak_vram_mb double, gpu_utilization_pct double, gpu_power_watts double, "
    "gpu_memory_used_mb double, gpu_memory_total_mb double"
)


def run_from_path(path: Column) -> Column:
    """Run name: the `run_name=` folder if there is one, else the parent folder."""
    named = partition_value(path, "run_name")
    return F.when(named != "", named).otherwise(F.regexp_extract(plain_path(path), r"([^/]+)/[^/]*$", 1))


def _fields(lines: DataFrame) -> DataFrame:
    fields = F.split(F.trim("value"), " +")
    return lines.select(
        "run_name",
        "value",
        F.get(fields, F.lit(0)).try_cast("int").alias("_step"),
        F.get(fields, F.lit(1)).alias("_kind"),
        F.get(fields, F.lit(2)).try_cast("double").alias("_value"),
        (F.size(fields) == 3).alias("_whole"),
    )


_READABLE = "_whole AND _step IS NOT NULL AND _value IS NOT NULL"


def parse_text_log(lines: DataFrame) -> DataFrame:
    """(run_name, step, kind, value) from (run_name, value) lines; lines that
    aren't such a record are left to `unreadable_lines`."""
    return _fields(lines).filter(_READABLE).select(
        "run_name", F.col("_step").alias("step"), F.col("_kind").alias("kind"), F.col("_value").alias("value")
    )


def unreadable_lines(lines: DataFrame) -> DataFrame:
    """(run_name, value) of blank, cut or malformed lines."""
    return _fields(lines).filter(f"NOT ({_READABLE})").select("run_name", "value")


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.option("recursiveFileLookup", "true").text(path)
    return files.select(run_from_path(F.col("_metadata.file_path")).alias("run_name"), "value")


def read_text_logs(spark: SparkSession, path: str) -> DataFrame:
    return parse_text_log(read_log_lines(spark, path))


def append_text_logs(lines: DataFrame, path: str) -> None:
    """Append lines under one folder per run; existing files stay untouched."""
    lines.write.mode("append").partitionBy("run_name").text(path)


def read_csv_logs(spark: SparkSession, path: str, schema: str = TRAIN_LOG_SCHEMA, files: str = "*.csv") -> DataFrame:
    """Structured logs with a declared schema; the run comes from the path.

    `files` picks one kind of log where folders hold several (such as
    `val_logs.csv` beside `train_logs.csv`). Headers must name the schema's columns in order: a
    file of another kind fails rather than being read by position.
    """
    reader = spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", files)
    rows = reader.option("enforceSchema", "false").csv(path, header=True)
    return rows.select(run_from_path(F.col("_metadata.file_path")).alias("run_name"), "*")


def append_csv_logs(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").partitionBy("run_name").csv(path, header=True)
