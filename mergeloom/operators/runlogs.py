"""Run-log analytics: validation, schedules, time accounting, summaries.

Per-run running columns use the range-split totals of `prefix`, so one long
run does not end up in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .joins import join_bounded
from .prefix import running

# Validation and checkpoint cadence, and batches per validation.
VAL_EVERY = 250
CHECKPOINT_EVERY = 5000
VAL_BATCHES = 20


def with_last_step(log: DataFrame, key: str = "run_name") -> DataFrame:
    """Add `last_step`, the greatest step of the run."""
    return join_bounded(log, log.groupBy(key).agg(F.max("step").alias("last_step")), key)


def is_validation_step(step: Column, last: Column, every: int = VAL_EVERY) -> Column:
    return (step % every == 0) | (step == last)


def is_checkpoint_step(step: Column, last: Column, every: int = CHECKPOINT_EVERY) -> Column:
    return (step > 0) & ((step % every == 0) | (step == last))


def schedule_parameters(configs: DataFrame, world: int = 1) -> DataFrame:
    """Derived schedule columns of run configs, with a validity flag."""
    per_pass = F.col("batch_size") * F.col("block_size") * world
    return configs.withColumns(
        {
            "min_lr": F.col("max_lr") * F.col("min_lr_ratio"),
            "warmup_steps": F.expr("warmup_tokens div total_batch_size"),
            "max_steps": F.expr("max_tokens div total_batch_size"),
            "grad_accum": F.expr(f"total_batch_size div (batch_size * block_size * {world})"),
            "divisible": F.col("total_batch_size") % per_pass == 0,
        }
    )


def learning_rate(step: Column, max_lr: Column, min_lr: Column, warmup: Column, max_steps: Column) -> Column:
    """Linear warm-up, then cosine decay to the minimum rate."""
    done = F.try_divide((step - warmup).cast("double"), (max_steps - warmup).cast("double"))
    cosine = 0.5 * (1.0 + F.cos(F.lit(math.pi) * done))
    return (
        F.when(step < warmup, max_lr * (step + 1) / warmup)
        .when(step > max_steps, min_lr)
        .otherwise(min_lr + cosine * (max_lr - min_lr))
    )


def perplexity(val_loss: Column) -> Column:
    return F.exp(val_loss)


def throughput(B: Column, T: Column, grad_accum: Column, world: Column, seconds: Column) -> Column:
    return F.try_divide(B * T * grad_accum * world, seconds)


def validation_loss(batch_losses: DataFrame, loss: str = "loss", batches: int = VAL_BATCHES) -> DataFrame:
    """(run_name, step, val_loss) over the first batches of each validation."""
    return (
        batch_losses.filter(F.col("batch_idx") < batches)
        .groupBy("run_name", "step")
        .agg(F.avg(loss).alias("val_loss"))
    )


def accumulated_loss(micro: DataFrame, grad_accum: int) -> DataFrame:
    return micro.groupBy("run_name", "step").agg(
        F.sum(F.col("loss") / F.lit(grad_accum)).alias("train_loss")
    )


def rank_average(losses: DataFrame, loss: str = "loss") -> DataFrame:
    return losses.groupBy("run_name", "step").agg(F.avg(loss).alias("loss"))


def best_validation(val_log: DataFrame) -> DataFrame:
    """(run_name, best_val_loss, best_val_step): lowest loss, earliest step on
    ties, NaN never."""
    usable = val_log.filter(F.col("val_loss").isNotNull() & ~F.isnan("val_loss"))
    best = F.min(F.struct("val_loss", "step"))
    return usable.groupBy("run_name").agg(best.alias("b")).select(
        "run_name", F.col("b.val_loss").alias("best_val_loss"), F.col("b.step").alias("best_val_step")
    )


def best_so_far(val_log: DataFrame) -> DataFrame:
    """Add `best_so_far`, the running minimum of val_loss per run."""
    value = F.when(~F.isnan("val_loss"), F.col("val_loss"))
    return running(val_log, "step", {"best_so_far": ("min", value, True)}, ["run_name"])


def run_summary(train_log: DataFrame, val_log: DataFrame, configs: DataFrame) -> DataFrame:
    """One row per run: all columns of its config, best validation, last step,
    time, early-stop flag."""
    ends = train_log.groupBy("run_name").agg(
        F.max("step").alias("last_step"), F.max("elapsed_seconds").alias("elapsed_seconds")
    )
    return (
        configs.join(ends, "run_name", "left")
        .join(best_validation(val_log), "run_name", "left")
        .withColumn("stopped_due_to_time", F.col("last_step") < F.col("max_steps") - 1)
    )


def training_elapsed(log: DataFrame, wall: str, non_training: str) -> DataFrame:
    """Add `training_elapsed`: wall time minus earlier non-training time."""
    summed = running(log, "step", {"_paused": ("sum", F.col(non_training), False)}, ["run_name"])
    return summed.withColumn("training_elapsed", F.col(wall) - F.col("_paused")).drop("_paused")


def periodic_validations(log: DataFrame, every: float, elapsed: str = "training_elapsed") -> DataFrame:
    """(run_name, period, step): first step in each elapsed period from 1 on;
    skipped periods fire once, at the step that passes them."""
    period = F.floor(F.col(elapsed) / F.lit(every))
    return (
        log.withColumn("period", period)
        .filter(F.col("period") >= 1)
        .groupBy("run_name", "period")
        .agg(F.min("step").alias("step"))
    )


def steps_before_stop(log: DataFrame, limit: float, elapsed: str = "training_elapsed") -> DataFrame:
    """Rows of each run before its first step at or over the time limit."""
    stops = log.filter(F.col(elapsed) >= limit).groupBy("run_name").agg(F.min("step").alias("_stop"))
    joined = join_bounded(log, stops, "run_name", "left")
    return joined.filter(F.col("_stop").isNull() | (F.col("step") < F.col("_stop"))).drop("_stop")


def final_validations(train_log: DataFrame, val_log: DataFrame) -> DataFrame:
    """Runs whose last validated step is not their last step, with that step."""
    trained = train_log.groupBy("run_name").agg(F.max("step").alias("step"))
    validated = val_log.groupBy("run_name").agg(F.max("step").alias("last_val_step"))
    joined = trained.join(validated, "run_name", "left")
    return joined.filter(~F.col("step").eqNullSafe(F.col("last_val_step")))


def text_log_lines(rows: DataFrame) -> DataFrame:
    """(run_name, value): one `step kind value` line per row, four decimals."""
    line = F.format_string("%d %s %.4f", F.col("step").cast("bigint"), "kind", "value")
    return rows.select("run_name", line.alias("value"))


def union_logs(train_log: DataFrame, val_log: DataFrame, eval_log: DataFrame) -> DataFrame:
    """One (run_name, step, kind, value) stream from the three kinds of log."""
    kinds = ((train_log, "train_loss", "train"), (val_log, "val_loss", "val"), (eval_log, "acc", "hella"))
    parts = [
        df.select("run_name", "step", F.lit(kind).alias("kind"), F.col(value).alias("value"))
        for df, value, kind in kinds
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def last_config_wins(grid: DataFrame) -> DataFrame:
    """Duplicate names keep the last definition at the first one's position."""
    others = [c for c in grid.columns if c not in ("run_name", "ord")]
    return (
        grid.groupBy("run_name")
        .agg(F.min("ord").alias("position"), F.max(F.struct("ord", *others)).alias("c"))
        .select("position", "run_name", *[F.col(f"c.{c}").alias(c) for c in others])
    )
