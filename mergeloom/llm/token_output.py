"""Training-order materialisation of token sequences in fixed-stride binary shards.

Each input partition's documents are encoded, ended with the end id, chained
and cut into sequences of `SEQUENCE` ids; its last sequence is padded with end
ids. Partition p numbers its sequences p * room, p * room + 1, ..., where `room`
bounds the sequences of any partition (an id covers one byte of text at
least). A keyed Feistel network over the next power of four, walked until it falls inside
the domain, permutes those numbers: every sequence gets a slot of its own, in
an order that only the key decides. Slots are dealt to shards by range; within a
shard, records stand in slot order. The sequence's position is its rank by slot, which the
shards' sizes give without another pass: encoding runs once.

A record is `STRIDE` bytes: little-endian unsigned 16-bit ids and one closing
line feed, which lets Spark's text writer (and its commit protocol) write the
shards to any file system. Record r of a shard starts at r * STRIDE. The folder
`shard=k` holds shard k; `positions` reads the shards' sizes, `read_range` any range of positions.

Edge cases: null text is an empty document, one end id. Repeated rows and null
doc_ids are documents like others. An empty table writes nothing. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.prefix import running
from .common import join_bounded, new_path, text_of
from .encoding import Encoder, tokenizer_path

SEQUENCE = 2048
STRIDE = 2 * SEQUENCE + 1
END_ID = 1
#: Slots of a shard; about half of them are taken.
SHARD_SLOTS = 1 << 13
_ROUNDS = 6


def permuted(numbers: np.ndarray, size: int, key: int) -> np.ndarray:
    """Where a keyed permutation of 0..size-1 sends `numbers`."""
    half = np.uint64(max(1, (max(1, size - 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    keys = np.random.default_rng(key).integers(0, 1 << 63, _ROUNDS, dtype=np.uint64)
    out = np.asarray(numbers, np.uint64).copy()
    walking = np.ones(len(out), bool)
    while walking.any():
        left, right = out[walking] >> half, out[walking] & mask
        for k in keys:
            mixed = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
        out[walking] = (left << half) | right
        walking = out >= np.uint64(size)
    return out.astype(np.int64)


@dataclass(frozen=True)
class Shards:
    spark: SparkSession
    path: str

    def files(self) -> DataFrame:
        # The shard comes from the path: without files, Spark finds no partition column.
        reader = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").option("recursiveFileLookup", "true")
        return reader.load(self.path).withColumn("shard", F.regexp_extract("path", r"shard=(\d+)/[^/]*$", 1).cast("bigint"))

    def positions(self) -> DataFrame:
        """shard, path, length, records, first (position of the first record); a row per shard."""
        sizes = self.files().select("shard", "path", "length", (F.col("length") / STRIDE).cast("bigint").alias("records"))
        return running(sizes, "shard", {"first": ("sum", F.col("records"), False)})

    def records(self) -> DataFrame:
        """position, shard, byte_offset, ids (binary) of every record, read back from the files."""
        sizes = self.positions().select("shard", "first")
        rows = join_bounded(self.files().select("shard", "length", "content"), sizes, "shard").select(
            "shard", "first", "content", F.explode(F.sequence(F.lit(0).cast("bigint"), (F.col("length") / STRIDE).cast("bigint") - 1)).alias("r")
        )
        return rows.select(
            (F.col("first") + F.col("r")).alias("position"),
            "shard",
            (F.col("r") * STRIDE).alias("byte_offset"),
            F.substring("content", (F.col("r") * STRIDE + 1).cast("int"), F.lit(STRIDE - 1)).alias("ids"),
        )

    def read_range(self, first: int, last: int) -> DataFrame:
        """Records at positions first <= p < last, reading only the shards they lie in."""
        wanted = self.positions().where((F.col("first") < last) & (F.col("first") + F.col("records") > first))
        names = [r.shard for r in wanted.select("shard").collect()]
        return self.records().where(F.col("shard").isin(names) & F.col("position").between(first, last - 1)).orderBy("position")


def _room(rows: DataFrame) -> tuple[int, int]:
    """Partitions, and the most sequences that one of them can make."""
    per = rows.select(F.spark_partition_id().alias("p"), (F.octet_length("text") + 1).cast("bigint").alias("b")).groupBy("p").agg(F.sum("b").alias("b"))
    found = per.agg(F.max("p").alias("p"), F.max("b").alias("b")).first()
    return (found.p + 1, found.b // SEQUENCE + 1) if found.b else (0, 0)


def write_shards(docs: DataFrame, key: int, path: str | None = None, vocabulary: str | None = None) -> Shards:
    spark = docs.sparkSession
    path = path or new_path(spark, "token-shards")
    vocabulary = vocabulary or tokenizer_path()
    rows = docs.select(text_of(docs).alias("text"))
    parts, room = _room(rows)
    size = parts * room

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.cached(vocabulary)
        number, waiting, held = TaskContext.get().partitionId() * room, [], 0

        def cut(stream: np.ndarray) -> pa.RecordBatch:
            nonlocal number
            table = stream.reshape(-1, SEQUENCE)
            slots = permuted(np.arange(number, number + len(table)), size, key)
            number += len(table)
            return pa.RecordBatch.from_arrays(
                [pa.array(slots, pa.int64()), pa.array([r.tobytes() for r in table], pa.binary())], ["slot", "record"]
            )

        for batch in batches:
            for text in batch.column(0):
                waiting += [encoder.encode(text.as_py()).astype("<u2"), np.array([END_ID], "<u2")]
                held += len(waiting[-2]) + 1
                if held >= 512 * SEQUENCE:
                    stream = np.concatenate(waiting)
                    whole = held // SEQUENCE * SEQUENCE
                    yield cut(stream[:whole])
                    waiting, held = [stream[whole:]], held - whole
        if held:
            yield cut(np.concatenate([*waiting, np.full(-held % SEQUENCE, END_ID, "<u2")]))

    shards = max(1, -(-size // SHARD_SLOTS))
    placed = rows.mapInArrow(sequences, "slot bigint, record binary").withColumn("shard", (F.col("slot") / SHARD_SLOTS).cast("bigint"))
    ordered = placed.repartition(shards, "shard").sortWithinPartitions("shard", "slot")
    ordered.select("shard", F.col("record").cast("string").alias("value")).write.partitionBy("shard").option("lineSep", "\n").text(path)
    return Shards(spark, path)
