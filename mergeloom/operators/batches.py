"""Next-token training batches cut from token shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .joins import join_bounded
from .prefix import running


def batch_count(length: Column, batch_tokens: int, rank: Column, world: int) -> Column:
    """Batches a rank serves from one shard: the first always, another while
    its window and one look-ahead token fit the shard."""
    room = (length - 1 - rank * batch_tokens).cast("bigint")
    stride = batch_tokens * world
    whole = F.floor(room / F.lit(stride)).cast("bigint")
    return F.greatest(F.lit(1).cast("bigint"), whole)


def shard_batches(lengths: DataFrame, B: int, T: int, world: int = 1) -> DataFrame:
    """(split, shard_id, n_tokens, rank, n_batches)."""
    ranked = lengths.withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(world - 1))))
    return ranked.select(
        "split", "shard_id", "n_tokens", "rank",
        batch_count(F.col("n_tokens"), B * T, F.col("rank"), world).alias("n_batches"),
    )


def batch_rows(pieces: DataFrame, lengths: DataFrame, B: int, T: int, world: int = 1) -> DataFrame:
    """(split, shard_id, batch_idx, rank, row, x, y) with |x| = |y| = T.

    Row g of a shard covers its tokens [gT, gT+T], so every piece knows which
    rows it feeds. A row inside one piece stays where it is; parts of the others meet in a
    group of at most T+1 tokens. `pieces` is read twice and should be a stored table.
    A first batch the shard is too short for yields only its complete rows.
    """
    size = F.size("tokens")
    first = F.greatest(F.lit(0), F.ceil((F.col("start") - T) / F.lit(T)).cast("bigint"))
    last = F.floor((F.col("start") + size - 1) / F.lit(T)).cast("bigint")
    fed = pieces.filter(size > 0).withColumn("g", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("start"), F.col("g") * T)
    end = F.least(F.col("start") + size, F.col("g") * T + T + 1)
    part = F.slice("tokens", (begin - F.col("start") + 1).cast("int"), (end - begin).cast("int"))
    full = end - begin == T + 1
    parts = fed.where(~full).select("split", "shard_id", "g", begin.alias("at"), part.alias("part"))
    met = (
        parts.groupBy("split", "shard_id", "g")
        .agg(
            F.array_sort(F.collect_list(F.struct("at", "part"))).alias("p"),
            F.sum(F.size("part")).alias("n"),
        )
        .filter(F.col("n") == T + 1)
        .select("split", "shard_id", "g", F.flatten(F.transform("p", lambda p: p["part"])).alias("w"))
    )
    rows = fed.where(full).select("split", "shard_id", "g", part.alias("w")).unionByName(met)
    per_stride = B * world
    placed = rows.select(
        "split",
        "shard_id",
        F.expr(f"g div {per_stride}").alias("batch_idx"),
        F.expr(f"(g % {per_stride}) div {B}").cast("int").alias("rank"),
        F.expr(f"g % {B}").cast("int").alias("row"),
        "w",
    )
    served = shard_batches(lengths, B, T, world).select("split", "shard_id", "rank", "n_batches")
    return (
        join_bounded(placed, served, ["split", "shard_id", "rank"])
        .filter(F.col("batch_idx") < F.col("n_batches"))
        .select(
            "split", "shard_id", "batch_idx", "rank", "row",
            F.slice("w", 1, T).alias("x"),
            F.slice("w", 2, T).alias("y"),
        )
    )


def batch_schedule(micro_steps: DataFrame, lengths: DataFrame, B: int, T: int, grad_accum: int) -> DataFrame:
    """Which batch each micro-step of a single rank reads.

    `micro_steps` has (step, micro); batches are read shard by shard in order
    and start over after the last one. Adds (cycle, shard_id, batch_idx).

    A shard is an interval of batch numbers. Numbers are cut into as many equal stretches as
    there are shards; a shard stands under each stretch it reaches into (three times as many rows as shards at most),
    a step under the one its number falls into, and the interval that holds the number wins. So what
    is joined does not depend on the number of batches.
    """
    served = shard_batches(lengths, B, T)
    starts = running(served, "shard_id", {"before": ("sum", F.col("n_batches"), False)})
    total, shards = served.agg(F.coalesce(F.sum("n_batches"), F.lit(0)), F.count(F.lit(1))).first()
    total = max(total, 1)  # without shards there is nothing to meet
    stretch = -(-total // max(shards, 1))
    reach = F.sequence(F.expr(f"before div {stretch}"), F.expr(f"(before + n_batches - 1) div {stretch}"))
    spans = starts.select("shard_id", "before", "n_batches", F.explode(reach).alias("_stretch"))
    number = F.col("step").cast("bigint") * grad_accum + F.col("micro")
    wanted = micro_steps.withColumn("_n", number).select(
        *micro_steps.columns,
        F.expr(f"_n div {total}").alias("cycle"),
        F.expr(f"_n % {total}").alias("_slot"),
        F.expr(f"_n % {total} div {stretch}").alias("_stretch"),
    )
    inside = (F.col("_slot") >= F.col("before")) & (F.col("_slot") < F.col("before") + F.col("n_batches"))
    return join_bounded(wanted, spans, "_stretch").where(inside).select(
        *micro_steps.columns, "cycle", "shard_id", (F.col("_slot") - F.col("before")).alias("batch_idx")
    )


def round_robin(df: DataFrame, index: str, world: int) -> DataFrame:
    """Add `rank`: row i goes to rank i mod world."""
    return df.withColumn("rank", (F.col(index) % world).cast("int"))
