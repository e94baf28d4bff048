"""Near-duplicate documents by fast similarity sketching.

A document's set is its distinct 5-word shingles. A sketch of t coordinates is
filled in rounds: in each of the first t rounds every shingle is thrown into
one bin and offers the value (round, hash); in round t + i every shingle goes to bin i,
so every coordinate fills. Each coordinate keeps its least value. Later rounds only give
larger values, so throwing stops once all bins are filled. The sketch is cut
into bands; documents that share a band are candidates, and every link is
confirmed on full sets (100 * intersection >= 75 * union).

How hot groups stay linear: documents with equal sets become one class first;
in a bucket every class is compared with the bucket's smallest id only (a
star), then, where a bucket still holds several components, with its shortest text. Members of buckets that even then
hold several components are compared
across components by exact prefix filtering on rare shingles, so no linked pair
of a bucket is lost and large groups of copies never meet in all pairs. Shingles of a template that many
texts share meet only texts of sizes that can be similar. (Texts that are linked in very many pairs, none of them
through a bucket's smallest id or shortest text, would still meet in as many pairs as there are links.)

Edge cases: null text counts as empty. A document without words has an empty
set, links to nothing and stays. Fewer than five words make one shingle. Rows
that share a doc_id are one node of the link graph. A null doc_id is never a
smallest id: such a row takes its class's component, or null and stays when it
has none. Extra columns are ignored by `decide` and kept by `deduplicate`, which decides by row: a doc_id
used for different texts stays with each of them that `decide` keeps, and rows of one doc_id and
one set stay once (the least MD5 of the text). Very long texts are worked on whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .blocks import NOT_SPACE, Words, grams, mix, plain, slices, words
from ..operators.joins import join_back
from .common import cut_lineage, give_back, join_bounded, text_of, thinned
from .components import components

SHINGLE = 5
COORDINATES = 128
BANDS = 32
SIMILAR = 75
#: Pairs with one document that a task confirms together; an item in more documents than `HOT_ITEM` is dealt to parts.
LINKS_A_PART = 500
HOT_ITEM = 64
HOT_PARTS = 4
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_SEEDS = np.random.default_rng(7001).integers(0, 1 << 63, 2 * COORDINATES, dtype=np.uint64)
_BAND = np.random.default_rng(7002).integers(0, 1 << 63, BANDS, dtype=np.uint64)


def shingles(w: Words, row: int) -> np.ndarray:
    """Distinct shingle hashes of one row, sorted."""
    first, last = w.rows[row], w.rows[row + 1]
    if last == first:
        return np.zeros(0, np.uint64)
    return np.unique(grams(w.hashes[first:last], min(SHINGLE, last - first)))


def sketch(items: np.ndarray) -> np.ndarray:
    """The least (round, hash) of every coordinate; `items` isn't empty."""
    out = np.full(COORDINATES, _EMPTY)
    at_once = max(1, 1024 // len(items))
    for first in range(0, COORDINATES, at_once):
        rounds = np.arange(first, min(COORDINATES, first + at_once), dtype=np.uint64)[:, None]
        thrown = mix(items ^ _SEEDS[first : first + len(rounds)][:, None])
        bins = (thrown % np.uint64(COORDINATES)).astype(np.intp)
        np.minimum.at(out, bins.ravel(), ((rounds << np.uint64(56)) | (thrown >> np.uint64(8))).ravel())
        if out.max() != _EMPTY:
            return out
    for i in np.flatnonzero(out == _EMPTY):
        value = mix(items ^ _SEEDS[COORDINATES + i]).min() >> np.uint64(8)
        out[i] = (np.uint64(COORDINATES + i) << np.uint64(56)) | value
    return out


def band_keys(coordinates: np.ndarray) -> np.ndarray:
    keys = _BAND.copy()
    for column in coordinates.reshape(BANDS, -1).T:
        keys = mix(keys ^ column) + _BAND
    return keys.view(np.int64)


def _sketched(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        sizes, classes, bands, lengths = [], [], [], []
        for part in slices(plain(texts)):
            w = words(part, NOT_SPACE)
            for row in range(len(part)):
                items = shingles(w, row)
                sizes.append(len(items))
                if len(items):
                    classes.append(hashlib.blake2b(items.tobytes(), digest_size=16).digest())
                    bands.append(band_keys(sketch(items)))
                else:
                    classes.append(None)
                lengths.append(BANDS if len(items) else 0)
        offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
        keys = pa.array(np.concatenate(bands) if bands else np.zeros(0, np.int64))
        yield pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()), pa.ListArray.from_arrays(offsets, keys)],
            ["n", "cls", "bands"],
        )
    give_back()


def _sets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        sets = []
        for part in slices(plain(texts)):
            w = words(part, NOT_SPACE)
            sets += [shingles(w, row).view(np.int64) for row in range(len(part))]
        offsets = pa.array(np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32))
        yield pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64)))
    give_back()


def _sets_of(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """(id, items) for the documents in `ids`, stored."""
    text = text_of(docs)
    wanted = join_bounded(docs.select(docs["doc_id"].cast("bigint").alias("id"), text.alias("text")), ids, "id", "left_semi")
    return cut_lineage(wanted.select("id", F.arrow_udf(_sets, "array<bigint>")("text").alias("items")), "shingle-sets")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough.

    Many pairs with one `b` are dealt to parts, and its set goes to each of them.
    """
    per_b = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / F.lit(LINKS_A_PART)).alias("parts")).where("parts > 1")
    dealt = join_bounded(pairs, per_b, "b", "left")
    dealt = dealt.select("a", "b", F.pmod(F.xxhash64("a"), F.coalesce("parts", F.lit(1))).alias("part"))
    firsts = dealt.join(sets.select(F.col("id").alias("a"), F.col("items").alias("x")), "a")
    seconds = dealt.select("b", "part").distinct().join(sets.select(F.col("id").alias("b"), F.col("items").alias("y")), "b")
    both = firsts.join(seconds, ["b", "part"])
    shared = F.size(F.array_intersect("x", "y")).cast("bigint")
    measured = both.select("a", "b", shared.alias("shared"), (F.size("x") + F.size("y")).cast("bigint").alias("total"))
    return measured.where(F.col("shared") * 100 >= (F.col("total") - F.col("shared")) * SIMILAR).select("a", "b").distinct()


def _step(length: Column) -> Column:
    """Lengths in geometric steps of 2 %."""
    return F.floor(F.ln(length.cast("double")) / F.ln(F.lit(1.02))).cast("int")


def _met(prefixes: DataFrame) -> DataFrame:
    """Pairs of prefix rows (item, df, id, root, n, i) that share an item, the shorter document's `id`, `root`, `n`, `i`
    beside the longer one's `b`, `other`, `m`, `j`.

    A similar pair's first common shingle is followed by at least 3/7 of both sizes together in either document. So it
    stands in the first seventh of the shorter one, and its place there bounds the longer one's size:
    rows of shingles that many documents share meet only sizes (in steps) that can still be similar.
    """
    both = 100 + SIMILAR
    shorter = prefixes.where((F.col("n") - F.col("i")) * both >= 2 * SIMILAR * F.col("n"))
    shorter = shorter.withColumn("longest", F.floor((F.col("n") - F.col("i")) * both / F.lit(SIMILAR)) - F.col("n"))
    longer = prefixes.select("item", "df", F.col("id").alias("b"), F.col("root").alias("other"), F.col("n").alias("m"), F.col("i").alias("j"))
    hot = F.col("df") > HOT_ITEM
    few = shorter.where(~hot).drop("df").join(longer.where(~hot).drop("df"), "item")
    steps = F.sequence(_step(F.col("n")), _step(F.col("longest")))
    probes = shorter.where(hot).drop("df").withColumn("step", F.explode(steps)).withColumn("part", F.explode(F.array(*map(F.lit, range(HOT_PARTS)))))
    probed = longer.where(hot).drop("df").withColumn("step", _step(F.col("m"))).withColumn("part", F.pmod(F.xxhash64("b"), F.lit(HOT_PARTS)).cast("int"))
    many = probes.join(probed, ["item", "step", "part"]).drop("step", "part")
    return few.unionByName(many)


def _prefixes(left: DataFrame, sets: DataFrame) -> DataFrame:
    """(item, df, id, root, n, i): the first quarter of each document's shingles in order of rarity."""
    rows = left.join(sets, "id").select("id", "root", F.size("items").cast("bigint").alias("n"), F.explode("items").alias("item"))
    rows = cut_lineage(rows, "cross-items")
    often = rows.groupBy("item").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    order = Window.partitionBy("id").orderBy("df", "item")
    # Shingles of one document only come first; they count as places, but meet nothing.
    placed = rows.join(often, "item", "left").withColumn("df", F.coalesce("df", F.lit(1))).withColumn("i", F.row_number().over(order) - 1)
    placed = placed.where((F.col("df") > 1) & ((F.col("n") - F.col("i")) * 100 >= F.col("n") * SIMILAR))
    return cut_lineage(placed.select("item", "df", "id", "root", "n", "i"), "prefixes")


def _cross_pairs(left: DataFrame, sets: DataFrame) -> DataFrame:
    """Every pair (a, b) of `left` (id, root) in different components that can
    still be similar enough: exact prefix filtering.

    A document's shingles are put in order of rarity. A similar pair's first
    common shingle then stands early in either, and what follows
    it bounds the intersection. Passages that many documents share come last,
    so they don't bring documents together.
    """
    met = _met(_prefixes(left, sets))
    most = F.least(F.col("n") - F.col("i"), F.col("m") - F.col("j"))
    can = most * (100 + SIMILAR) >= (F.col("n") + F.col("m")) * SIMILAR
    ordered = (F.col("n") < F.col("m")) | ((F.col("n") == F.col("m")) & (F.col("id") < F.col("b")))
    pairs = met.where(ordered & (F.col("root") != F.col("other")) & can)
    return pairs.select(F.greatest("id", "b").alias("a"), F.least("id", "b").alias("b")).distinct()


def _undecided(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, id, root) of the buckets that hold several components."""
    sided = buckets.join(roots.withColumnRenamed("node", "id"), "id", "left").select("key", "id", F.coalesce("root", "id").alias("root"))
    mixed = sided.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least < most").select("key")
    return join_back(sided, mixed, "key")


def links(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, root) of the link graph over class representatives.

    `nodes` has doc_id and bands; `docs` gives their texts.
    """
    banded = nodes.select(F.col("doc_id").alias("id"), F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min("id").alias("leader")).where("members > 1")
    buckets = cut_lineage(banded.join(shared.select("key", "leader"), "key"), "buckets")
    sets = _sets_of(buckets.select("id").distinct(), docs)
    stars = buckets.where("id <> leader").select(F.col("id").alias("a"), F.col("leader").alias("b")).distinct()
    linked = cut_lineage(_confirmed(stars, sets), "star-links")
    roots = components(linked)

    # A template's shortest page is the one most like the others.
    left = cut_lineage(_undecided(buckets.select("key", "id"), roots), "mixed")
    if left.isEmpty():
        return roots
    sizes = sets.select("id", F.size("items").alias("n"))
    sized = left.join(sizes, "id")
    shortest = sized.groupBy("key").agg(F.min(F.struct("n", "id", "root")).alias("s")).select("key", "s.*")
    shortest = shortest.select("key", F.col("id").alias("leader"), F.col("root").alias("led"))
    more = join_back(left, shortest, "key").where("root <> led").select(F.col("id").alias("a"), F.col("leader").alias("b")).distinct()
    linked = linked.unionByName(cut_lineage(_confirmed(cut_lineage(more, "second-stars"), sets), "second-links"))
    roots = components(linked)

    left = cut_lineage(_undecided(left.select("key", "id"), roots).select("id", "root").distinct(), "undecided")
    more = cut_lineage(_confirmed(_cross_pairs(left, sets), sets), "cross-links")
    return components(linked.unionByName(more)) if not more.isEmpty() else roots


def decide(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row."""
    return _decided(docs).drop("cls", "key")


def _key(docs: DataFrame) -> Column:
    return F.struct(docs["doc_id"].cast("bigint").alias("id"), F.md5(text_of(docs).cast("binary")).alias("md5"))


def _decided(docs: DataFrame) -> DataFrame:
    """`decide` with each row's class and key (doc_id, MD5 of the text)."""
    s = F.arrow_udf(_sketched, "struct<n:bigint,cls:binary,bands:array<bigint>>")(text_of(docs))
    rows = cut_lineage(docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), _key(docs).alias("key"), s.alias("s")), "sketches")
    rows = rows.select("doc_id", "key", "s.n", "s.cls", "s.bands")
    classes = cut_lineage(rows.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("rep")), "classes")
    reps = rows.where("cls is not null and doc_id is not null").join(
        classes.select("cls", F.col("rep").alias("doc_id")), ["cls", "doc_id"], "left_semi"
    ).dropDuplicates(["cls", "doc_id"])
    roots = links(reps.select("doc_id", "bands"), docs)
    placed = classes.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        "cls", F.coalesce("root", "rep").alias("component_id")
    )
    component = F.coalesce("component_id", "doc_id")
    return rows.select("doc_id", "key", "n", "cls").join(placed, "cls", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"),
        "cls",
        "key",
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """One document of every component, all columns."""
    rows = cut_lineage(_decided(docs).select("doc_id", "cls", "key", "kept"), "near-marks")
    same = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.hex("cls")).cast("binary"))
    per_key = rows.where("kept and cls is not null").groupBy(same.alias("same"), "key").agg(F.count(F.lit(1)).alias("rows"))
    per_set = per_key.groupBy("same").agg(F.min("key").alias("least"), F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("texts"))
    per_set = cut_lineage(per_set.where("rows > 1"), "repeated-sets")
    others = join_back(per_key.select("same", "key"), per_set.where("texts > 1").select("same", "least"), "same")
    others = others.where("key <> least").select("key")
    dropped = rows.where("not kept").select("key").unionByName(others).distinct()
    return thinned(docs, _key(docs), dropped, per_set.select("least"))
