"""Byte-quota split of a corpus into train and test documents."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .prefix import running


class QuotaCuts(NamedTuple):
    last_train: int | None
    last_test: int | None


# Documents looked at first; many times more each time, then the whole corpus.
_FRONT = 4096
_WIDEN = 16
_LARGEST_FRONT = 1 << 20


def _cuts(sizes: DataFrame, train_bytes: int, test_bytes: int) -> tuple[QuotaCuts, bool]:
    """Cuts within (doc_id, bytes) rows, and whether both quotas are full there."""
    summed = running(sizes, "doc_id", {"before": ("sum", F.col("bytes"), False)})
    before = F.col("before")
    train = (
        summed.filter(before < train_bytes)
        .agg(F.max("doc_id").alias("last"), F.sum("bytes").alias("total"))
        .first()
    )
    total = train["total"] or 0
    past_train = (before >= train_bytes) & (before - total < test_bytes)
    test = summed.filter(past_train).agg(F.max("doc_id").alias("last"), F.sum("bytes").alias("total")).first()
    last_test = test["last"]
    if train_bytes <= 0 and last_test is None:
        last_test = sizes.agg(F.min("doc_id")).first()[0]
    return QuotaCuts(train["last"], last_test), total >= train_bytes and (test["total"] or 0) >= test_bytes


def quota_cuts(docs: DataFrame, train_bytes: int = 100_000, test_bytes: int = 100_000) -> QuotaCuts:
    """The last doc_id each quota takes.

    A document is train while the train bytes before it are below the target,
    so the one that crosses stays whole; later ones are test while the test
    bytes before them are below theirs. With a train target of 0 the first
    document is always taken as test. Both sides are therefore doc_id ranges.

    Text is read from the front only, by a pushed-down doc_id filter, as far
    as the quotas reach: the front's bound comes from the doc_id column alone, and it is
    widened until both quotas are full.
    """
    front = _FRONT
    while True:
        ids = docs.select("doc_id")
        bound = ids.orderBy("doc_id").limit(front).agg(F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n")).first()
        whole = bound["n"] < front or front > _LARGEST_FRONT
        part = docs if whole else docs.filter(F.col("doc_id") <= bound["last"])
        sizes = cut_lineage(
            part.select("doc_id", F.octet_length("text").cast("bigint").alias("bytes")), "doc-bytes"
        )
        cuts, full = _cuts(sizes, train_bytes, test_bytes)
        if full or whole:
            return cuts
        front *= _WIDEN


def quota_split(docs: DataFrame, train_bytes: int = 100_000, test_bytes: int = 100_000) -> DataFrame:
    """Documents either quota takes, with `split`: a pushed-down doc_id filter."""
    cuts = quota_cuts(docs, train_bytes, test_bytes)
    ends = [c for c in cuts if c is not None]
    label = F.lit("test")
    if cuts.last_train is not None:
        label = F.when(F.col("doc_id") <= cuts.last_train, "train").otherwise("test")
    kept = docs.filter(F.col("doc_id") <= max(ends)) if ends else docs.limit(0)
    return kept.withColumn("split", label)
