"""Fixed-size token shards cut from the concatenated document stream."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import ragged
from ..functions.ragged import list_rows, next_in_chain, shifted_rows, with_successor
from .joins import join_bounded
from .prefix import running

# Executors need not have this package installed: its task code travels along.
cloudpickle.register_pickle_by_value(ragged)


def split_label(shard_id: Column | str) -> Column:
    """Shard 0 is held out."""
    shard_id = F.col(shard_id) if isinstance(shard_id, str) else shard_id
    return F.when(shard_id == 0, "val").otherwise("train")


def document_offsets(token_docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Add `offset`: tokens before the document in doc_id order."""
    n = F.col("n_tokens").cast("bigint")
    return running(token_docs, "doc_id", {"offset": ("sum", n, False)}, parts=parts)


def shard_spans(offsets: DataFrame, shard_size: int) -> DataFrame:
    """(doc_id, shard_id, start, skip, take): which tokens of a document land
    where. The shards of a document are arithmetic on its offset, so this is
    an expansion, not a range join."""
    first = F.expr(f"offset div {shard_size}")
    last = F.expr(f"(offset + n_tokens - 1) div {shard_size}")
    spans = offsets.filter(F.col("n_tokens") > 0).withColumn("shard_id", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("offset"), F.col("shard_id") * shard_size)
    end = F.least(F.col("offset") + F.col("n_tokens"), (F.col("shard_id") + 1) * shard_size)
    return spans.select(
        *[c for c in offsets.columns if c not in ("offset", "n_tokens")],
        F.col("shard_id").cast("int").alias("shard_id"),
        (begin - F.col("shard_id") * shard_size).alias("start"),
        (begin - F.col("offset")).cast("int").alias("skip"),
        (end - begin).cast("int").alias("take"),
    )


def pack_shards(token_docs: DataFrame, shard_size: int, parts: int | None = None) -> DataFrame:
    """(split, shard_id, start, doc_id, tokens, n_tokens): pieces of every shard.

    Every shard but the last is full; a document longer than a shard spans
    several. Input should be a stored table, it is read for totals first.
    """
    spans = shard_spans(document_offsets(token_docs, parts), shard_size)
    piece = F.slice("tokens", F.col("skip") + 1, F.col("take"))
    return spans.select(
        split_label("shard_id").alias("split"), "shard_id", "start", "doc_id", piece.alias("tokens"),
        F.col("take").alias("n_tokens"),
    )


def piece_length(pieces: DataFrame) -> Column:
    """Tokens of a piece: kept since packing, counted where it wasn't."""
    kept = F.col("n_tokens") if "n_tokens" in pieces.columns else F.size("tokens")
    return kept.cast("bigint")


def shard_lengths(pieces: DataFrame) -> DataFrame:
    return pieces.groupBy("split", "shard_id").agg(F.sum(piece_length(pieces)).alias("n_tokens"))


def next_tokens(pieces: DataFrame) -> DataFrame:
    """Add `labels`: each token's successor in its shard, NULL at the end. A
    piece without tokens has no labels, and the pieces around it are neighbours.

    Only first tokens cross rows. Inside a partition, sorted where it stands, each piece takes the
    label of its last token from the next piece. What begins or ends a run of neighbours there is
    published as (shard, start, first token), and closes the gaps of the others: a join on single runs, of
    which a partition of consecutive pieces has few. No token array is shuffled.

    `pieces` is read twice and must be a stored table, as `read_shards` gives it.
    """
    full = pieces.where(piece_length(pieces) > 0)
    order = ["shard_id", "start"]
    narrow = full.select("shard_id", "start", piece_length(pieces).alias("n"), F.get("tokens", F.lit(0)).alias("first"))

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = True  # whether the first row of the batch begins a run
        for batch, last in with_successor(batches):
            shard, start, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard_id", "start", "n"))
            follows = next_in_chain(shard, start, n)
            heads = np.flatnonzero(np.r_[opened, ~follows])
            # The last row comes again as the next batch's first one.
            heads = heads if last else heads[heads < len(shard) - 1]
            opened = not follows[-1] if len(follows) else opened
            yield batch.select(["shard_id", "start", "first"]).take(pa.array(heads))

    schema = T.StructType(
        [*full.schema.fields, T.StructField("labels", T.ArrayType(T.IntegerType())), T.StructField("_open", T.LongType())]
    )

    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, last in with_successor(batches):
            values, lengths = list_rows(batch.column("tokens"))
            shard, start = (batch.column(c).to_numpy(zero_copy_only=False) for c in order)
            follows = np.r_[next_in_chain(shard, start, lengths), False]
            told = batch.num_rows if last else batch.num_rows - 1
            labels = shifted_rows(values, lengths, follows)
            open_at = pa.array(start + lengths, pa.int64(), mask=follows)
            columns = [*batch.columns, labels, open_at]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names).slice(0, told)

    heads = narrow.sortWithinPartitions(*order).mapInArrow(begin, "shard_id int, start bigint, first int")
    heads = heads.toDF("_s", "_at", "_head")
    rows = full.sortWithinPartitions(*order).mapInArrow(shift, schema)
    met = join_bounded(rows, heads, (F.col("shard_id") == F.col("_s")) & (F.col("_open") == F.col("_at")), "left")
    closed = F.concat(F.slice("labels", F.lit(1), F.size("labels") - 1), F.array(F.col("_head")))
    labels = F.when(F.col("_head").isNotNull(), closed).otherwise(F.col("labels"))
    empty = pieces.where(piece_length(pieces) == 0).select(*pieces.columns, F.array().cast("array<int>").alias("labels"))
    return met.select(*pieces.columns, labels.alias("labels")).unionByName(empty)
