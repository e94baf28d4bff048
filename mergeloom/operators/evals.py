"""Scoring of multiple-choice evaluations and candidate distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .joins import join_back


_STEP = 256.0


def log_mass(rows: DataFrame, keys: list[str], logit: str, *extra: Column) -> DataFrame:
    """(keys..., peak, mass, extra...): the maximum and sum(exp(logit - peak)) per key.

    Logits are summed in bands of 256, each relative to its own base, which
    neither overflows nor needs the maximum first. So the rows are aggregated once,
    combined on the map side; what follows has a row per key and band. `extra` are further
    aggregates by maximum, named.
    """
    band = F.floor(F.col(logit) / _STEP)
    bands = rows.groupBy(*keys, band.alias("_band")).agg(
        F.max(logit).alias("_top"), F.sum(F.exp(F.col(logit) - F.floor(F.col(logit) / _STEP) * _STEP)).alias("_sum"), *extra
    )
    names = [c for c in bands.columns if c not in (*keys, "_band", "_top", "_sum")]
    peak = F.max("_top").over(W.partitionBy(*keys))
    scaled = bands.withColumn("peak", peak).withColumn("_sum", F.col("_sum") * F.exp(F.col("_band") * _STEP - F.col("peak")))
    return scaled.groupBy(*keys).agg(
        F.max("peak").alias("peak"), F.sum("_sum").alias("mass"), *[F.max(c).alias(c) for c in names]
    )


def position_loss(scores: DataFrame, keys: list[str]) -> DataFrame:
    """Cross-entropy per position from (keys..., cand, logit, target):
    log-sum-exp minus the target's logit, in one pass over the rows."""
    hit = F.max(F.when(F.col("cand") == F.col("target"), F.col("logit"))).alias("hit")
    return log_mass(scores, keys, "logit", hit).select(
        *keys, (F.col("peak") + F.log("mass") - F.col("hit")).alias("loss")
    )


def shift_mask(rows: DataFrame) -> DataFrame:
    """Align each position's loss with the mask of the next position.

    (example_id, cand_id, pos, loss, mask): the mask row of p+1 is re-keyed to
    p and both meet in an aggregation, so no candidate is held in one window.
    Positions without a successor drop out, as the last one has no target.
    """
    own = F.struct(F.col("pos").alias("at"), F.col("loss").alias("l"), F.lit(None).cast("int").alias("m"))
    moved = F.struct(
        (F.col("pos") - 1).alias("at"), F.lit(None).cast("double").alias("l"), F.col("mask").alias("m")
    )
    pairs = rows.select("example_id", "cand_id", F.explode(F.array(own, moved)).alias("v"))
    met = pairs.groupBy("example_id", "cand_id", F.col("v.at").alias("pos")).agg(
        F.max("v.l").alias("loss"), F.max("v.m").alias("mask")
    )
    return met.filter(F.col("loss").isNotNull() & F.col("mask").isNotNull())


def masked_loss(rows: DataFrame, loss: str = "loss", extra: list[str] | None = None) -> DataFrame:
    """(example_id, cand_id, extra..., loss_sum, mask_sum, avg_loss) over aligned rows."""
    return (
        rows.groupBy("example_id", "cand_id", *(extra or []))
        .agg(F.sum(F.col(loss) * F.col("mask")).alias("loss_sum"), F.sum("mask").alias("mask_sum"))
        .withColumn("avg_loss", F.try_divide("loss_sum", "mask_sum"))
    )


def predictions(candidates: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """(example_id, extra..., pred): lowest mean loss, ties to the lowest candidate;
    candidates without a mean never win. `extra` columns depend on the example only."""
    keys = ["example_id", *(extra or [])]
    tied = candidates.filter(F.col("avg_loss").isNotNull()).groupBy(*keys, "avg_loss").agg(F.min("cand_id").alias("cand_id"))
    return tied.groupBy(*keys).agg(F.min_by("cand_id", "avg_loss").alias("pred"))


def accuracy(preds: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by..., num_correct, num_total, acc) from (example_id, pred, label)."""
    hit = F.sum((F.col("pred") == F.col("label")).cast("bigint"))
    return (
        preds.groupBy(*(by or []))
        .agg(hit.alias("num_correct"), F.count(F.lit(1)).alias("num_total"))
        .withColumn("acc", F.try_divide("num_correct", "num_total"))
    )


def softmax(rows: DataFrame, key: str, logit: str) -> DataFrame:
    """Add `prob` within each key: one aggregation and one join back, split by
    a salt, so a key with a third of all rows stays spread over tasks."""
    totals = log_mass(rows, [key], logit).select(key, F.col("peak").alias("_peak"), F.col("mass").alias("_mass"))
    share = F.exp(F.col(logit) - F.col("_peak")) / F.col("_mass")
    return join_back(rows, totals, key).withColumn("prob", share).drop("_peak", "_mass")


def top_candidates(rows: DataFrame, key: str, cand: str, prob: str, k: int = 50) -> DataFrame:
    """The k most probable candidates per key, ties to the lowest candidate."""
    order = W.partitionBy(key).orderBy(F.desc(prob), F.asc(cand))
    return rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def weighted_draw(rows: DataFrame, key: str, cand: str, prob: str, seed: int, k: int = 50) -> DataFrame:
    """One candidate per key among the top k, in proportion to `prob`.

    An exponential clock per candidate: the smallest -ln(u)/prob wins, with u
    from 52 bits of an md5 of (seed, key, candidate), so retries, and other engines, draw the same rows.
    """
    kept = top_candidates(rows.filter(F.col(prob) > 0), key, cand, prob, k)
    named = F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"), F.col(cand).cast("string"))
    bits = F.conv(F.substring(F.md5(named.cast("binary")), 1, 13), 16, 10).cast("bigint")
    clock = -F.log((bits + 1) / F.lit(float(1 << 52))) / F.col(prob)
    return kept.groupBy(key).agg(F.min_by(cand, clock).alias(cand))
