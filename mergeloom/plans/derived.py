"""Inputs derived from the given tables: run logs, eval losses, chat text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.joins import join_back, join_bounded
from ..operators.prefix import dense_index
from ..operators.runlogs import VAL_EVERY, is_validation_step, with_last_step
from ..sources.corpus import table


def train_log(spark: SparkSession, sf: str) -> DataFrame:
    """(run_name, step, train_loss, elapsed_seconds): one run per event type."""
    events = table(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    steps = dense_index(events, "event_id", "step", ["event_type"])
    starts = events.groupBy("event_type").agg(F.min("ts").alias("t0"))
    elapsed = (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("t0").cast("timestamp"))) / 1e6
    return join_bounded(steps, starts, "event_type").select(
        F.col("event_type").alias("run_name"),
        "step",
        F.col("value").alias("train_loss"),
        elapsed.alias("elapsed_seconds"),
    )


def val_log(log: DataFrame) -> DataFrame:
    marked = with_last_step(log)
    kept = marked.filter(is_validation_step(F.col("step"), F.col("last_step")))
    return kept.select("run_name", "step", F.col("train_loss").alias("val_loss"), "elapsed_seconds")


def periodic_val_log(log: DataFrame) -> DataFrame:
    """Validations on the cadence only, before the final one is appended."""
    due = log.filter(F.col("step") % VAL_EVERY == 0)
    return due.select("run_name", "step", F.col("train_loss").alias("val_loss"), "elapsed_seconds")


def micro_loss(log: DataFrame, per_step: int = 8) -> DataFrame:
    return log.select(
        "run_name",
        F.expr(f"step div {per_step}").alias("step"),
        (F.col("step") % per_step).alias("micro"),
        F.col("train_loss").alias("loss"),
    )


def eval_loss(spark: SparkSession, sf: str) -> DataFrame:
    """(example_id, cand_id, loss_cents, mask, label) from order lines."""
    lines = table(spark, sf, "lineitem")
    return lines.select(
        F.col("l_partkey").alias("example_id"),
        (F.col("l_linenumber") % 4).cast("int").alias("cand_id"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("loss_cents"),
        F.when(F.col("l_quantity") > 10, 1).otherwise(0).alias("mask"),
        (F.col("l_partkey") % 4).alias("label"),
    )


def scores(spark: SparkSession, sf: str) -> DataFrame:
    """(row_id, cand, logit): one candidate per event of a user."""
    events = table(spark, sf, "events")
    return events.select(
        F.col("user_id").alias("row_id"), F.col("event_id").alias("cand"), F.col("value").alias("logit")
    )


def probabilities(score_rows: DataFrame) -> DataFrame:
    """(row_id, cand, prob): each candidate's share of its row."""
    mass = score_rows.groupBy("row_id").agg(F.sum(F.round(F.col("logit") * 100).cast("bigint")).alias("mass"))
    share = F.round(F.col("logit") * 100) / F.col("mass")
    return join_back(score_rows, mass, "row_id").select("row_id", "cand", share.alias("prob"))


def eval_positions(spark: SparkSession, sf: str) -> DataFrame:
    """(example_id, cand_id, pos, loss, mask): a user's events as token positions
    of four candidates; the mask belongs to the position's token."""
    events = table(spark, sf, "events").select(
        F.col("user_id").alias("example_id"),
        (F.col("event_id") % 4).cast("int").alias("cand_id"),
        "event_id",
        F.round(F.col("value") * 100).cast("double").alias("loss"),
        (F.col("event_type") != "view").cast("int").alias("mask"),
    )
    return dense_index(events, "event_id", "pos", ["example_id", "cand_id"]).drop("event_id")


def chat_text(spark: SparkSession, sf: str) -> DataFrame:
    """(conv_id, turn, text) with the role as a leading special token."""
    rows = table(spark, sf, "conversations")
    text = F.concat(F.lit("<|"), "role", F.lit("|>"), "text")
    return rows.select("conv_id", "turn", text.alias("text"))


def run_configs(spark: SparkSession, sf: str) -> DataFrame:
    """(ord, run_name, schedule inputs): one config per part, brands repeat."""
    part = table(spark, sf, "part")
    size = F.col("p_size").cast("bigint")
    return part.select(
        F.col("p_partkey").alias("ord"),
        F.col("p_brand").alias("run_name"),
        (size % 8 + 1).alias("n_layer"),
        F.lit(4).cast("bigint").alias("batch_size"),
        (64 * (size % 4 + 1)).alias("block_size"),
        (4096 * (size % 3 + 1)).alias("total_batch_size"),
        (size * 100_000).alias("max_tokens"),
        (size * 10_000).alias("warmup_tokens"),
        (F.round("p_retailprice").cast("bigint") / 1e6).alias("max_lr"),
        F.lit(0.5).alias("min_lr_ratio"),
    )


def log_configs(spark: SparkSession, sf: str) -> DataFrame:
    """Schedule inputs of the logged runs; budgets follow the run's users."""
    users = table(spark, sf, "events").groupBy(F.col("event_type").alias("run_name")).agg(
        F.countDistinct("user_id").alias("users")
    )
    return users.select(
        "run_name",
        F.lit(4).cast("bigint").alias("batch_size"),
        F.lit(256).cast("bigint").alias("block_size"),
        F.lit(4096).cast("bigint").alias("total_batch_size"),
        (F.col("users") * 20 * 4096).alias("max_tokens"),
        (F.col("users") * 4096).alias("warmup_tokens"),
        F.lit(6e-4).alias("max_lr"),
        F.lit(0.1).alias("min_lr_ratio"),
    )
