"""Exact dedup against a persistent digest index.

The index is a Parquet table bucketed and sorted by digest. New data is reduced
to one row per digest first (combined on the map side, so a text that fills a
third of the rows is one row per task), then anti-joined with the index by
sort-merge and appended. The index side of that join is never shuffled.

Edge cases: null text counts as empty, and all empty or blank texts form one
group. Among equal texts the one with the most code points stays, then the
smallest doc_id (null ids last). Where that doc_id has several of the texts, only those with
the most code points are marked kept. Rows that repeat a doc_id and a text are one
document: both are marked like it. Extra columns are ignored by `decide`, and
kept by `deduplicate`, which returns one row of each group. A doc_id that is used for different texts
stays with each of them that is unique. Very long texts are hashed whole. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import cut_lineage, new_path, text_of, thinned

_SCHEMA = "digest binary, keep_id bigint, chars bigint, rows bigint"


def digest(text: Column) -> Column:
    """SHA-256 of the text without ASCII white space, as lowercase hex."""
    return F.sha2(F.regexp_replace(text, r"[ \t-\r]+", "").cast("binary"), 256)


@dataclass
class DigestIndex:
    """A digest table at `path`; reopen one by giving its path and bucket count."""

    spark: SparkSession
    path: str
    buckets: int

    def __post_init__(self) -> None:
        self.name = f"digest_index_{uuid.uuid4().hex}"
        self.spark.sql(
            f"CREATE TABLE {self.name} ({_SCHEMA}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )

    def known(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, groups: DataFrame) -> None:
        rows = groups.select("digest", "keep_id", "chars", "rows").repartition(self.buckets, "digest")
        rows.write.mode("append").format("parquet").bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.name)

    def add(self, docs: DataFrame) -> DataFrame:
        """Decide on every row of `docs` and append its new digests.

        A digest seen in an earlier batch keeps the row chosen then; group_size
        counts the rows of this batch. `chars` is the row's own.
        """
        text = text_of(docs)
        rows = cut_lineage(
            docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), F.length(text).cast("bigint").alias("chars"), digest(text).alias("hex")),
            "digests",
        ).select("doc_id", "chars", F.unhex("hex").alias("digest"))
        per_length = rows.groupBy("digest", "chars").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("doc_id"))
        groups = cut_lineage(
            per_length.groupBy("digest").agg(
                F.max_by("doc_id", "chars").alias("keep_id"), F.max("chars").alias("chars"), F.sum("n").alias("rows")
            ),
            "digest-groups",
        )
        known = self.known().select("digest", "keep_id")
        fresh = groups.join(known.hint("merge"), "digest", "left_anti")
        seen = groups.drop("keep_id").join(known.hint("merge"), "digest")
        most = F.col("chars").alias("most")
        decided = cut_lineage(fresh.select("digest", "keep_id", "rows", most, F.lit(True).alias("fresh")).unionByName(
            seen.select("digest", "keep_id", "rows", most, F.lit(False).alias("fresh"))
        ), "digest-decisions")
        self.append(groups.join(decided.where("fresh").select("digest"), "digest", "left_semi"))
        return rows.join(decided, "digest").select(
            "doc_id",
            "keep_id",
            F.col("rows").alias("group_size"),
            (F.col("fresh") & F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("most"))).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
            "chars",
        )


    def merged(self, path: str) -> "DigestIndex":
        """A copy at `path` with one sorted file per bucket. Each batch adds files to the buckets, which
        readers sort again; an index of many batches is worth merging now and then."""
        copy = DigestIndex(self.spark, path, self.buckets)
        copy.append(self.known())
        return copy


def new_index(spark: SparkSession, buckets: int | None = None) -> DigestIndex:
    """An empty index in the work folder; by default a bucket per shuffle partition."""
    return DigestIndex(spark, new_path(spark, "digest-index"), buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))


def decide(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row."""
    return (index or new_index(docs.sparkSession)).add(docs).drop("chars")


def deduplicate(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The rows of `docs` that stay, all columns."""
    rows = cut_lineage((index or new_index(docs.sparkSession)).add(docs), "dedup-marks")
    rows = rows.select(F.struct(F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha"), "chars").alias("own"), "kept")
    # A digest keeps rows of one doc_id and one length, so its repeats share a key.
    repeated = rows.where("kept").groupBy("own").count().where("count > 1").select("own")
    text = text_of(docs)
    own = F.struct(docs["doc_id"].cast("bigint").alias("id"), digest(text).alias("sha"), F.length(text).cast("bigint").alias("chars"))
    return thinned(docs, own, rows.where("not kept").select("own").distinct(), repeated)
