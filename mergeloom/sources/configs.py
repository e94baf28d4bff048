"""Run configurations as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The default run configuration.
DEFAULTS = {
    "batch_size": 4,
    "total_batch_size": 100,
    "max_tokens": 10_000_000,
    "max_lr": 6e-6,
    "min_lr_ratio": 0.5,
    "warmup_tokens": 1_000_000,
    "block_size": 256,
    "vocab_size": 50257,
    "n_layer": 3,
    "n_head": 4,
    "n_embd": 256,
    "seed": 1337,
    "max_time_seconds": 360_000.0,
    "validation_time_delta": 18_000,
}

_TYPES = {int: "bigint", float: "double"}
CONFIG_SCHEMA = "ord int, run_name string, " + ", ".join(
    f"{name} {_TYPES[type(value)]}" for name, value in DEFAULTS.items()
)


def config_grid(spark: SparkSession, entries: list[tuple[str, dict]]) -> DataFrame:
    """(ord, run_name, parameters...) from named overrides, in order; names may
    repeat, `last_config_wins` resolves them."""
    rows = []
    for i, (name, overrides) in enumerate(entries):
        unknown = set(overrides) - set(DEFAULTS)
        if unknown:
            raise ValueError(f"unknown parameters {sorted(unknown)}")
        merged = {**DEFAULTS, **overrides}
        rows.append((i, name, *[type(DEFAULTS[k])(merged[k]) for k in DEFAULTS]))
    return spark.createDataFrame(rows, CONFIG_SCHEMA)
