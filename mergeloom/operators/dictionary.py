"""Chunk dictionary and adjacent-pair counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.codes import adjacent_pairs
from ..functions.text import GPT4_PATTERN, chunks

# A position in the corpus is doc_id * 2^31 + chunk index, exact as a decimal
# for every bigint doc_id and every index that an array can have.
_PLACES = "cast(2147483648 as decimal(10,0))"


def corpus_position(doc_id: Column, index: Column) -> Column:
    """One orderable number for (doc_id, index); decimals aggregate by hash."""
    return doc_id.cast("decimal(19,0)") * F.expr(_PLACES) + index.cast("decimal(10,0)")


def nested_position(position: Column, index: Column) -> Column:
    """A place inside a position: 63 + 2 x 31 bits are below 10^38."""
    return position * F.expr(_PLACES) + index.cast("decimal(10,0)")


def position_parts(position: Column) -> tuple[Column, Column]:
    """(doc_id, index) of a position, negative ids included."""
    index = F.pmod(position, F.expr(_PLACES))
    return ((position - index) / F.expr(_PLACES)).cast("bigint"), index.cast("int")


def exploded_chunks(docs: DataFrame, pattern: str = GPT4_PATTERN, keep: list[str] | None = None) -> DataFrame:
    """(keep..., chunk_idx, chunk), one row per pattern match."""
    keep = keep or ["doc_id"]
    return docs.select(*keep, F.posexplode(chunks("text", pattern)).alias("chunk_idx", "chunk"))


def chunk_dictionary(docs: DataFrame, pattern: str = GPT4_PATTERN, group: list[str] | None = None) -> DataFrame:
    """Distinct chunks with count and first position, per group.

    (group..., chunk, cnt, first_doc, first_idx), for any bigint doc_id. The
    aggregation combines on the map side, so a chunk making up a third of the
    corpus costs one row per task.
    """
    group = group or []
    keys = list(dict.fromkeys([*group, "doc_id"]))
    position = corpus_position(F.col("doc_id"), F.col("chunk_idx"))
    doc, index = position_parts(F.col("_p"))
    return (
        exploded_chunks(docs, pattern, keys)
        .groupBy(*group, "chunk")
        .agg(F.count(F.lit(1)).alias("cnt"), F.min(position).alias("_p"))
        .select(*group, "chunk", "cnt", doc.alias("first_doc"), index.alias("first_idx"))
    )


def exploded_pairs(weighted: DataFrame, code: Column | str = "code") -> DataFrame:
    """(weighted columns..., pair_idx, pair): overlapping pairs inside each
    code string, so `aaa` gives (a,a) twice."""
    code = F.col(code) if isinstance(code, str) else code
    rest = [c for c in weighted.columns if c != "code"]
    pairs = weighted.select(*rest, F.posexplode(adjacent_pairs(code)).alias("pair_idx", "pair"))
    return pairs.filter(F.col("pair").isNotNull())


def add_counts(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Add one count table into another (keys..., cnt)."""
    cols = [*keys, "cnt"]
    return left.select(*cols).unionByName(right.select(*cols)).groupBy(*keys).agg(F.sum("cnt").alias("cnt"))
