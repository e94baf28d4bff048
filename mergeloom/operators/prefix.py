"""Running totals over a global order without a one-partition window.

Rows are cut into key ranges at sampled keys. The range of a row depends
on its key and the boundaries only, so any retry puts it in the same range.
Totals per range give each range its starting value, and a window inside each
range does the rest: one narrow aggregate and one shuffle, with every range
holding about 1/parts of the rows even if one group owns most of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .joins import join_bounded

_FOLDS = {"sum": F.sum, "min": F.min, "max": F.max}


# Sampled keys per range; they decide how even the ranges are, never the result.
_SAMPLES = 32


def range_bounds(df: DataFrame, key: str, parts: int) -> list[int]:
    """At most parts-1 ascending integer boundaries.

    Picked from about 32 keys per range, the only rows that reach the driver.
    A hash of the row's columns (its group and key) selects them, so there is no
    merging of sketches in one task, a retried task selects the same ones, and a
    key that every group has doesn't bring one row per group.
    """
    if parts < 2:
        return []
    step = max(1, df.count() // (_SAMPLES * parts))
    picked = df.filter(F.pmod(F.xxhash64(*df.columns), F.lit(step)) == 0).select(key)
    sample = sorted(r[0] for r in picked.collect() if r[0] is not None)
    return sorted({sample[len(sample) * i // parts] for i in range(1, parts)} if sample else set())


def range_index(key: Column | str, bounds: list[int]) -> Column:
    """Number of boundaries <= key, by binary search on a literal array."""
    key = F.col(key) if isinstance(key, str) else key
    if not bounds:
        return F.lit(0)
    depth = len(bounds).bit_length()
    top = max(bounds)
    padded = bounds + [top] * (2**depth - len(bounds))
    table = F.from_json(F.lit(str(padded)), "array<bigint>")
    halves = F.from_json(F.lit(str([2**d for d in reversed(range(depth))])), "array<int>")
    n = len(bounds)
    return F.aggregate(
        halves,
        F.lit(0),
        lambda low, half: F.when(
            (low + half <= n) & (F.get(table, low + half - 1) <= key), low + half
        ).otherwise(low),
    )


def running(
    df: DataFrame,
    key: str,
    columns: dict[str, tuple[str, Column, bool]],
    group: list[str] | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Add running columns `out -> (fold, value, inclusive)` in `key` order.

    `key` is an integer column, unique within `group`. An exclusive sum starts
    at 0; an exclusive min/max starts at NULL. `df` is read twice, so it should
    be a stored table when it is expensive to derive.
    """
    group = group or []
    # A few ranges per shuffle partition even out their sizes.
    parts = parts or 3 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = range_bounds(df.select(*group, key), key, parts)
    ranged = df.withColumn("_range", range_index(key, bounds))
    totals = ranged.groupBy(*group, "_range").agg(
        *[_FOLDS[fold](value).alias(f"_t_{out}") for out, (fold, value, _) in columns.items()]
    )
    # At most `parts` rows per group reach this window.
    before = W.partitionBy(*group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    bases = totals.select(
        *[F.col(g).alias(f"_g_{g}") for g in group],
        F.col("_range").alias("_r"),
        *[
            _FOLDS[fold](f"_t_{out}").over(before).alias(f"_b_{out}")
            for out, (fold, _, _) in columns.items()
        ],
    )
    # Null-safe equality keeps Catalyst from inferring filters through the
    # binary search, which it cannot rebind on the aggregated side.
    same = F.col("_range").eqNullSafe(F.col("_r"))
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    # At most `parts` rows per group; beyond the limit the join shuffles on
    # (group, range), which no group can overload.
    joined = join_bounded(ranged, bases, same)
    within = W.partitionBy(*group, "_range").orderBy(key)
    out_cols = []
    for out, (fold, value, inclusive) in columns.items():
        frame = within.rowsBetween(W.unboundedPreceding, 0 if inclusive else -1)
        local = _FOLDS[fold](value).over(frame)
        base = F.col(f"_b_{out}")
        if fold == "sum":
            col = F.coalesce(local, F.lit(0)) + F.coalesce(base, F.lit(0))
        elif fold == "min":
            col = F.least(local, base)
        else:
            col = F.greatest(local, base)
        out_cols.append(col.alias(out))
    return joined.select(*df.columns, *out_cols)


def dense_index(
    df: DataFrame, key: str, out: str, group: list[str] | None = None, parts: int | None = None
) -> DataFrame:
    """0-based position of each row in `key` order (per group)."""
    one = F.lit(1).cast("bigint")
    return running(df, key, {out: ("sum", one, False)}, group, parts)
