"""Corpus scans, named samples and whole-file samples."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..functions.text import DOC_SEPARATOR, GPT2_PATTERN, GPT4_PATTERN, chunks
from ..operators.dictionary import chunk_dictionary, corpus_position, position_parts
from ..operators.joins import join_bounded
from ..operators.prefix import dense_index, range_bounds, range_index, running
from ..session import cut_lineage
from .paths import partition_value, plain_path

# Where each pattern breaks a white-space run that holds a separator.
_CUTS = {GPT4_PATTERN: "after_newline", GPT2_PATTERN: "before_last"}
# Type of `corpus_position`.
_PLACE = "decimal(31,0)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(docs: DataFrame) -> DataFrame:
    """Use every core on a corpus stored in too few splits to do so by itself.

    A corpus with at least one split per core is read in place, unshuffled.
    """
    cores = docs.sparkSession.sparkContext.defaultParallelism
    if docs.rdd.getNumPartitions() >= cores:
        return docs
    return docs.repartition(cores, "doc_id")


def scan_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text); document order comes from doc_id only."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


def first_documents(docs: DataFrame, n: int) -> DataFrame:
    return docs.orderBy("doc_id").limit(n)


def file_stem() -> Column:
    name = F.regexp_extract(plain_path(F.col("_metadata.file_path")), r"([^/]*)$", 1)
    return F.regexp_replace(name, r"\.[^.]*$", "")


def parent_folder(key: str) -> Column:
    """The value of a `key=value` folder in the file's path."""
    return partition_value(F.col("_metadata.file_path"), key)


def whole_file_samples(spark: SparkSession, path: str, name: Column | None = None) -> DataFrame:
    """One (sample, text) row per file, named by the file's stem by default."""
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    name = file_stem() if name is None else name
    return files.select(name.alias("sample"), F.col("value").alias("text"))


def named_samples(docs: DataFrame, name: Column) -> DataFrame:
    """Samples with given names: (sample, doc_id, text)."""
    return docs.select(name.alias("sample"), "doc_id", "text")


def numbered_samples(texts: DataFrame, key: str) -> DataFrame:
    """Each row is its own sample, named sample_0, sample_1, ... in key order."""
    numbered = dense_index(texts.select(F.col(key).alias("doc_id"), "text"), "doc_id", "_i")
    name = F.concat(F.lit("sample_"), F.col("_i").cast("string"))
    return numbered.select(name.alias("sample"), "doc_id", "text")


def _default_tail(cut: str | None) -> str:
    return DOC_SEPARATOR[:-1] if cut == "before_last" else DOC_SEPARATOR


def _lead_columns(cut: str | None) -> tuple[Column, Column, Column, Column]:
    """Leading white space of `text` (stored as _lead); what of it moves to the piece before (_moved);
    whether all of the text does (_blank); and what is given away, NULL for nothing."""
    lead = F.regexp_extract("text", r"(?U)^\s*", 0)
    if cut == "after_newline":
        moved = F.regexp_extract("text", r"(?U)^\s*[\r\n]", 0)
    elif cut == "before_last":
        moved = F.expr("substring(_lead, 1, greatest(length(_lead) - 1, 0))")
    else:
        moved = F.lit("")
    blank = (F.col("_lead") == F.col("text")) if cut else F.lit(False)
    leads = F.col("_lead") != "" if cut == "before_last" else moved != ""
    return lead, moved, blank, F.when(blank, F.col("text")).when(leads, moved)


def _own_text(cut: str | None, is_first: Column) -> Column:
    """A document's piece up to its tail."""
    own = F.expr("substring(text, length(_moved) + 1)")
    if cut == "before_last":
        own = F.concat(F.when(F.col("_lead") == "", F.lit(DOC_SEPARATOR[-1])).otherwise(""), own)
    return F.when(is_first, F.col("text")).otherwise(own)


def joined_dictionary(docs: DataFrame, pattern: str = GPT4_PATTERN, group: str | None = None) -> DataFrame:
    """The chunk dictionary of the separator-joined corpus (per group), as
    `chunk_dictionary(with_separators(docs, group, pattern), pattern, [group])`, in one scan of the text.

    What follows a document changes no chunk before its last one with a printing character. So the pass over the text
    counts the chunks before that one, and of each document passes on the rest (`zone`) and the
    leading white space that it gives away. These narrow rows are folded in document order: a zone and the
    white space after it are split again and counted on top.
    """
    cut = _CUTS.get(pattern)
    keys = [group] if group else []
    if not cut:
        return chunk_dictionary(with_separators(docs, group, pattern), pattern, keys)
    ends = docs.groupBy(*keys).agg(F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last"))  # reads no text
    ends = cut_lineage(ends.filter(F.col("_first").isNotNull()), "corpus-ends")
    if group:
        marked = join_bounded(docs.select(*keys, "doc_id", "text"), ends, keys)
    else:
        first, last = ends.first() or (None, None)
        marked = docs.select("doc_id", "text").withColumns({"_first": F.lit(first).cast("bigint"), "_last": F.lit(last).cast("bigint")})
    is_first = F.col("doc_id") == F.col("_first")
    lead, moved, blank, part = _lead_columns(cut)
    shaped = marked.withColumn("_lead", lead).select("*", moved.alias("_moved"), blank.alias("_blank"), part.alias("_part"))
    away = F.col("_blank") & ~is_first
    found = shaped.select(
        *keys, "doc_id", "_part", "_blank",
        F.when(away, F.array().cast("array<string>")).otherwise(chunks(_own_text(cut, is_first), pattern)).alias("_c"),
    )
    # Chunks before the last one that holds more than white space.
    stable = F.greatest(
        F.aggregate(
            F.sequence(F.lit(1), F.greatest(F.size("_c"), F.lit(1))), F.lit(0),
            lambda at, i: F.when(F.coalesce(F.get("_c", i - 1).rlike(r"(?U)\S"), F.lit(False)), i - 1).otherwise(at),
        ),
        F.lit(0),
    )
    cutted = found.withColumn("_z", stable)
    # A document's rows are its counted chunks and, last, its zone.
    zone = F.array_join(F.slice("_c", F.col("_z") + 1, F.greatest(F.size("_c") - F.col("_z"), F.lit(0))), "")
    pieces = F.concat(F.slice("_c", F.lit(1), F.col("_z")), F.array(zone))
    opened = cutted.select(*keys, "doc_id", "_part", "_blank", "_z", F.posexplode(pieces).alias("idx", "chunk"))
    is_zone = F.col("idx") == F.col("_z")
    rows = opened.select(
        *keys, "doc_id", "chunk", "idx", F.when(is_zone, F.col("doc_id").cast("bigint")).alias("owner"),
        F.when(is_zone, F.col("_part")).alias("part"), F.when(is_zone, F.col("_blank")).alias("blank"),
    )
    least = F.min(corpus_position(F.col("doc_id"), F.col("idx")))
    if not group and all(abs(end) < 1 << 31 for end in (first or 0, last or 0)):
        # The same places as bigints, which are cheaper to make and to compare.
        least = F.min(F.col("doc_id").cast("bigint") * (1 << 31) + F.col("idx")).cast(_PLACE)
    merged = rows.groupBy(*keys, "chunk", "owner", "part", "blank").agg(F.count(F.lit(1)).alias("cnt"), least.alias("_p"))
    merged = cut_lineage(merged, "chunks-and-zones")

    zones = merged.filter(F.col("owner").isNotNull()).select(
        *keys, F.col("owner").alias("doc_id"), F.col("chunk").alias("zone"), F.col("part").alias("_part"), F.col("blank").alias("_blank"),
        position_parts(F.col("_p"))[1].alias("_z"),
    )
    flagged = join_bounded(zones, ends, keys) if group else zones.withColumns({"_first": F.lit(first).cast("bigint"), "_last": F.lit(last).cast("bigint")})
    tail = F.when(F.col("doc_id") == F.col("_last"), F.lit("")).otherwise(F.lit(_default_tail(cut)))
    if not zones.filter(F.col("_part").isNotNull()).isEmpty():
        edges = _moved_tails(zones.select(*keys, "doc_id", "_blank", "_part"), ends, keys, _default_tail(cut))
        flagged = join_bounded(flagged, edges, [*keys, "doc_id"], "left")
        tail = F.coalesce("_tail", tail)
    kept = flagged.filter((F.col("doc_id") == F.col("_first")) | ~F.col("_blank"))
    closing = kept.select(*keys, "doc_id", "_z", F.posexplode(chunks(F.concat("zone", tail), pattern)).alias("i", "chunk"))
    closing = closing.select(
        *keys, "chunk", F.lit(1).cast("bigint").alias("cnt"), corpus_position(F.col("doc_id"), F.col("_z") + F.col("i")).alias("_p")
    )
    both = merged.filter(F.col("owner").isNull()).select(*keys, "chunk", "cnt", "_p").unionByName(closing)
    doc, index = position_parts(F.col("_p"))
    whole = both.groupBy(*keys, "chunk").agg(F.sum("cnt").alias("cnt"), F.min("_p").alias("_p"))
    return whole.select(*keys, "chunk", "cnt", doc.alias("first_doc"), index.alias("first_idx"))


def with_separators(docs: DataFrame, group: str | None = None, pattern: str = GPT4_PATTERN) -> DataFrame:
    """Cut the separator-joined corpus (per group) into one piece per document,
    such that the chunks of the pieces are exactly the chunks of the whole.

    The separator and the white space around it form one run. Both published
    patterns always break inside that run: the default one after its last line
    break, the older one before its last character. The part of a document's
    leading white space before that point moves to the piece before; a blank
    document moves there whole. For any other pattern the separator simply
    follows its document.

    One extra pass reads the text for leading white space. Only documents that
    have some reach a join, on single documents, so group sizes do not matter.
    """
    keys = [group] if group else []
    cut = _CUTS.get(pattern)
    default_tail = _default_tail(cut)
    lead, moved, blank, part = _lead_columns(cut)
    shaped = docs.withColumn("_lead", lead)
    shaped = shaped.select("*", moved.alias("_moved"), blank.alias("_blank"))

    ends = docs.groupBy(*keys).agg(F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last"))
    ends = cut_lineage(ends.filter(F.col("_first").isNotNull()), "corpus-ends")
    edges = None
    if cut:
        narrow = docs.withColumn("_lead", lead).select(
            *keys, "doc_id", blank.alias("_blank"), part.alias("_part")
        )
        narrow = cut_lineage(narrow, "doc-edges")
        if not narrow.filter(F.col("_part").isNotNull()).isEmpty():
            edges = _moved_tails(narrow, ends, keys, default_tail)
    if group is None:
        first, last = ends.first() or (None, None)
        is_first, is_last = F.col("doc_id") == F.lit(first), F.col("doc_id") == F.lit(last)
        if edges is not None:
            shaped = join_bounded(shaped, edges, "doc_id", "left")
    else:
        sides = [
            F.struct(F.col("_first").alias("doc_id"), F.lit(True).alias("f"), F.lit(None).cast("boolean").alias("l")),
            F.struct(F.col("_last").alias("doc_id"), F.lit(None).cast("boolean").alias("f"), F.lit(True).alias("l")),
        ]
        marks = ends.select(*keys, F.explode(F.array(*sides)).alias("m")).select(
            *keys, "m.*", F.lit(None).cast("string").alias("_tail")
        )
        if edges is not None:
            marks = marks.unionByName(edges, allowMissingColumns=True)
        marks = marks.groupBy(*keys, "doc_id").agg(*[F.max(c).alias(c) for c in ("f", "l", "_tail")])
        shaped = join_bounded(shaped, marks, [*keys, "doc_id"], "left")
        is_first, is_last = F.coalesce("f", F.lit(False)), F.coalesce("l", F.lit(False))
    tail = F.when(is_last, F.lit("")).otherwise(F.lit(default_tail))
    if edges is not None:
        tail = F.coalesce("_tail", tail)
    own = _own_text(cut, is_first)
    pieces = shaped.filter(is_first | ~F.col("_blank"))
    return pieces.withColumn("text", F.concat(own, tail)).select(*docs.columns)


def _moved_tails(narrow: DataFrame, ends: DataFrame, keys: list[str], default_tail: str) -> DataFrame:
    """(keys..., doc_id, _tail) for documents followed by ones that give up
    leading white space. A tail is part of one chunk's white space."""
    if keys:
        flagged = join_bounded(narrow, ends, keys)
    else:
        first, last = ends.first()
        flagged = narrow.withColumns({"_first": F.lit(first), "_last": F.lit(last)})
    away = F.col("_blank") & (F.col("doc_id") != F.col("_first"))
    owned = running(flagged, "doc_id", {"_owner": ("max", F.when(~away, F.col("doc_id")), False)}, keys)
    given = owned.filter(F.col("_part").isNotNull() & (F.col("doc_id") != F.col("_first")))
    ordered = F.array_sort(F.collect_list(F.struct("doc_id", "_part", "_blank", "_last")))
    chains = given.groupBy(*keys, "_owner").agg(ordered.alias("c"))
    end = F.element_at("c", -1)
    closing = F.when(end["_blank"] & (end["doc_id"] != end["_last"]), default_tail).otherwise("")
    moved = F.array_join(F.transform("c", lambda d: F.concat(F.lit(DOC_SEPARATOR), d["_part"])), "")
    return chains.select(*keys, F.col("_owner").alias("doc_id"), F.concat(moved, closing).alias("_tail"))


def corpus_totals(docs: DataFrame, by: str) -> DataFrame:
    """Documents and bytes per label."""
    return docs.groupBy(by).agg(
        F.count(F.lit(1)).alias("docs"),
        F.sum(F.octet_length("text").cast("bigint")).alias("bytes"),
    )


# Documents' bytes in a file of an ordered export, about.
EXPORT_BYTES = 32 << 20
# Bytes that are hashed at once.
_PIECE = 8192
_EXPORT = "label string, part int, first_doc bigint, docs bigint, start bigint, bytes bigint"


def export_joined(docs: DataFrame, by: str, path: str, part_bytes: int = EXPORT_BYTES) -> DataFrame:
    """Write each label's documents in order, joined by the separator, as files of about `part_bytes`.

    A file holds a range of doc_id, label by label; the manifest beside them, which is returned, tells where:
    (label, part, first_doc, docs, start, bytes). A label's text is its stretches in the order of
    `part`, without the last separator. Null texts are left out. No text is gathered, whatever a label's size.
    """
    spark = docs.sparkSession
    rows = docs.where(F.col("text").isNotNull()).select(F.col(by).cast("string").alias("label"), "doc_id", "text")
    size = F.octet_length("text").cast("bigint") + len(DOC_SEPARATOR)
    total = rows.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    parts = max(1, -(-total // part_bytes))
    # The range of a row depends on its id alone, so both jobs agree on it.
    part = range_index("doc_id", range_bounds(rows.select("doc_id"), "doc_id", parts)).cast("int").alias("part")
    sizes = rows.select("label", part, "doc_id", size.alias("size")).groupBy("label", "part").agg(
        F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("docs"), F.sum("size").alias("bytes")
    )
    before = W.partitionBy("part").orderBy(F.col("label").asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    start = F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("start")
    sizes.select("label", "part", "first_doc", "docs", start, "bytes").write.parquet(f"{path}/manifest")
    placed = rows.select(part, "label", "doc_id", "text").repartition(parts, "part")
    ordered = placed.sortWithinPartitions("part", F.col("label").asc_nulls_first(), "doc_id")
    ordered.select("part", "text").write.partitionBy("part").option("lineSep", DOC_SEPARATOR).text(f"{path}/text")
    return read_export(spark, path)


def read_export(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_EXPORT).parquet(f"{path}/manifest")


def exported_pieces(spark: SparkSession, path: str) -> DataFrame:
    """(label, part, at, content): the exported texts in pieces of some kilobytes, ordered by (part, at)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(f"{path}/text")
    number = F.regexp_extract("path", r"part=(\d+)/[^/]*$", 1).cast("int").alias("part")
    manifest = read_export(spark, path)
    last = manifest.groupBy("label").agg(F.max("part").alias("_last"))
    ends = manifest.join(last.withColumnRenamed("label", "_label"), F.col("label").eqNullSafe(F.col("_label")))
    own = F.col("bytes") - F.when(F.col("part") == F.col("_last"), len(DOC_SEPARATOR)).otherwise(0)
    stretches = ends.select("label", "part", "start", own.alias("bytes")).where("bytes > 0")
    met = join_bounded(files.select(number, "content"), stretches, "part")
    at = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(_PIECE).cast("bigint"))).alias("at")
    length = F.least(F.col("bytes") - F.col("at"), F.lit(_PIECE)).cast("int")
    piece = F.substring("content", (F.col("start") + F.col("at") + 1).cast("int"), length)
    return met.select("label", "part", "start", "bytes", "content", at).select("label", "part", "at", piece.alias("content"))


def exported_digests(spark: SparkSession, path: str) -> DataFrame:
    """(label, bytes, digest): MD5 of each label's joined text, streamed piece by piece."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, md5, size = None, None, 0

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"label": pa.array([label], pa.string()), "bytes": [size], "digest": [md5.hexdigest()]})

        for batch in batches:
            for name, content in zip(batch.column("label").to_pylist(), batch.column("content")):
                if md5 is None or name != label:
                    if md5 is not None:
                        yield told()
                    label, md5, size = name, hashlib.md5(), 0
                raw = content.as_buffer()
                md5.update(raw)
                size += raw.size
        if md5 is not None:
            yield told()

    ordered = exported_pieces(spark, path).repartition("label").sortWithinPartitions("label", "part", "at")
    return ordered.select("label", "content").mapInArrow(digest, "label string, bytes bigint, digest string")
