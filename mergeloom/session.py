"""Session defaults and the shared work folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A single-JVM session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("mergeloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    ensure_work_dir(spark)
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: `spark.checkpoint.dir`."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder.rstrip("/")


def ensure_work_dir(spark: SparkSession) -> None:
    """Give a session on this machine alone a folder of its own if it has none;
    a cluster's must be set."""
    context = spark.sparkContext
    unset = not (spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir())
    if unset and context.master.split("[")[0] == "local":
        context.setCheckpointDir(tempfile.mkdtemp(prefix="mergeloom-"))


_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{_scratch.get() or work_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Tables written inside go to one folder of the work folder, which is deleted at the end.

    For work whose results are written elsewhere before the end, such as a micro-batch.
    """
    folder = new_path(spark, "scratch")
    token = _scratch.set(folder)
    try:
        yield folder
    finally:
        _scratch.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Spark deletes a query's shuffle files when the query ends, not when the driver collects its garbage.

    For a chain of queries that each write what the next one reads.
    """
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREE_SHUFFLES) if before is None else spark.conf.set(_FREE_SHUFFLES, before)


def cut_lineage(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write `df` once and read it back: later jobs never recompute its inputs,
    and a lost executor costs a re-read of the lost splits only."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
