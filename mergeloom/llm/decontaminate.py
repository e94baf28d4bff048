"""Benchmark decontamination by winnowing.

Words are lower-cased runs of digits, letters and non-ASCII characters. An item's windows are its runs of
10 words; a shorter item is one window. Of every 6 consecutive 5-word hashes
the smallest is kept as a fingerprint, for items and documents alike, so two
texts that share 10 words share a fingerprint. A document's fingerprints that
occur among the items' are extended: every window around the hit is looked up
and its words are compared with the item's. Windows of items shorter than ten words
lie below winnowing's guarantee; their single windows are looked up at every place.

The items' tables are broadcast in blocks of at most `BLOCK_BYTES` of item
text; with several blocks the scans are chained, each adding its hits to the
ones before, so no size of benchmark needs a shuffle or an unbounded broadcast.

Edge cases: null or wordless documents have no words and no hits; null or
wordless items have no window. Items that share an item_id count as one; an
item with a null id marks words and isn't listed. An empty benchmark hits nothing.
Repeated rows get the same result each. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .blocks import WORD, Words, grams, plain, slices, words
from .common import cut_lineage, give_back, text_of

WINDOW = 10
GRAM = 5
BLOCK_BYTES = 16 << 20
_SPAN = WINDOW - GRAM + 1


def winnow(hashes: np.ndarray) -> np.ndarray:
    """Places of the smallest hash of every `_SPAN` consecutive ones (the last of equals)."""
    count = len(hashes) - _SPAN + 1
    if count <= 0:
        return np.zeros(0, np.intp)
    best, place = hashes[:count].copy(), np.arange(count)
    for j in range(1, _SPAN):
        here = hashes[j : j + count]
        smaller = here <= best
        best = np.where(smaller, here, best)
        place[smaller] = np.flatnonzero(smaller) + j
    return np.unique(place)


@dataclass
class Items:
    """Windows of a block of items."""

    ids: list[str | None] = field(default_factory=list)
    fingerprints: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    lengths: list[int] = field(default_factory=list)  # window lengths below WINDOW
    #: By length: window hash -> [(its words, items that have it)]
    windows: dict[int, dict[int, list[tuple[tuple[bytes, ...], list[int]]]]] = field(default_factory=dict)
    known: dict[int, np.ndarray] = field(default_factory=dict)  # sorted window hashes by length


def items_of(rows: list[tuple[str | None, str]]) -> Items:
    out, prints = Items(), []
    for number, (item_id, text) in enumerate(rows):
        out.ids.append(item_id)
        w = words(pa.array([text], pa.string()), WORD)
        count = len(w.hashes)
        if not count:
            continue
        size = min(WINDOW, count)
        spelled = [w.word(i) for i in range(count)]
        if size == WINDOW:
            short = grams(w.hashes, GRAM)
            prints.append(short[winnow(short)])
        table = out.windows.setdefault(size, {})
        for start, key in enumerate(grams(w.hashes, size).tolist()):
            same = table.setdefault(key, [])
            spelling = tuple(spelled[start : start + size])
            owners = next((o for s, o in same if s == spelling), None)
            if owners is None:
                same.append((spelling, [number]))
            elif owners[-1] != number:
                owners.append(number)
    if prints:
        out.fingerprints = np.unique(np.concatenate(prints))
    out.known = {n: np.array(sorted(t), np.uint64) for n, t in out.windows.items()}
    out.lengths = sorted(n for n in out.windows if n < WINDOW)
    return out


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values occur in the sorted `known`."""
    place = np.searchsorted(known, values)
    place[place == len(known)] = 0
    return known[place] == values


def _candidates(w: Words, items: Items) -> Iterator[tuple[int, int]]:
    """(window length, first word) that may be a window of an item, over all rows of the slice."""
    total = len(w.hashes)
    row_end = np.repeat(w.rows[1:], np.diff(w.rows))
    if len(items.fingerprints):
        short = grams(w.hashes, GRAM)
        inside = row_end[: len(short)] >= np.arange(len(short)) + GRAM
        # Windows across two rows only add places, which are dropped below.
        chosen = winnow(short)
        hit = chosen[inside[chosen] & _among(short[chosen], items.fingerprints)]
        starts = np.unique((hit[:, None] - np.arange(_SPAN)).ravel())
        starts = starts[(starts >= 0) & (starts + WINDOW <= total)]
        starts = starts[starts + WINDOW <= row_end[starts]]
        for a in starts.tolist():
            yield WINDOW, a
    for size in items.lengths:
        long = grams(w.hashes, size)
        places = np.flatnonzero(_among(long, items.known[size]))
        for a in places[places + size <= row_end[places]].tolist():
            yield size, a


def scan(w: Words, items: Items, count: int) -> list[tuple[list[tuple[int, int]], set[int]]]:
    """Per row: hit spans (first word, end; row-relative) and hit items."""
    found: list[tuple[list[tuple[int, int]], set[int]]] = [([], set()) for _ in range(count)]
    if not len(w.hashes) or not items.windows:
        return found
    for size, start in _candidates(w, items):
        key = int(grams(w.hashes[start : start + size], size)[0])
        same = items.windows[size].get(key)
        if same is None:
            continue
        spelling = tuple(w.word(i) for i in range(start, start + size))
        for spelled, owners in same:
            if spelled == spelling:
                row = int(np.searchsorted(w.rows, start, "right")) - 1
                base = int(w.rows[row])
                found[row][0].append((start - base, start - base + size))
                found[row][1].update(owners)
    return found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_HITS = "struct<n_words:bigint,spans:array<struct<first:int,end:int>>,items:array<string>>"


def _scanner(shared) -> Callable[[Column, Column], Column]:
    def hits(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        items = shared.value
        for texts, before in batches:
            earlier, out, done = before.to_pylist(), [], 0
            for part in slices(plain(texts)):
                w = words(part, WORD)
                for row, (spans, owners) in enumerate(scan(w, items, len(part))):
                    old = earlier[done + row] or {"spans": [], "items": []}
                    spans = merged(spans + [(s["first"], s["end"]) for s in old["spans"]])
                    names = {items.ids[i] for i in owners} - {None} | set(old["items"])
                    out.append(
                        {
                            "n_words": int(w.rows[row + 1] - w.rows[row]),
                            "spans": [{"first": a, "end": b} for a, b in spans],
                            "items": sorted(names),
                        }
                    )
                done += len(part)
            kind = pa.struct(
                [
                    ("n_words", pa.int64()),
                    ("spans", pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))),
                    ("items", pa.list_(pa.string())),
                ]
            )
            yield pa.array(out, kind)
        give_back()

    return F.arrow_udf(hits, _HITS).asNondeterministic()


def _blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The items in blocks of bounded text; the driver holds one at a time."""
    rows, size = [], 0
    text = text_of(benchmark)
    for r in benchmark.select(benchmark["item_id"].cast("string").alias("i"), text.alias("t")).toLocalIterator(prefetchPartitions=True):
        if rows and size + len(r.t) > BLOCK_BYTES:
            yield items_of(rows)
            rows, size = [], 0
        rows.append((r.i, r.t))
        size += len(r.t)
    if rows:
        yield items_of(rows)


def marker(docs: DataFrame, benchmark: DataFrame) -> Column:
    """struct (n_words, spans, items) for the text of each row of `docs`."""
    context = docs.sparkSession.sparkContext
    text = text_of(docs)
    hits = F.lit(None).cast(_HITS)
    found = False
    for items in _blocks(benchmark):
        hits, found = _scanner(context.broadcast(items))(text, hits), True
    return hits if found else _scanner(context.broadcast(Items()))(text, hits)


def decide(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans for every row."""
    marked = docs.select(docs["doc_id"], marker(docs, benchmark).alias("m")).select("doc_id", "m.*")
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["first"])
    return marked.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        "spans",
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` without a hit, all columns as they are."""
    mark = "_hits"
    while mark in docs.columns:
        mark += "_"
    return docs.withColumn(mark, marker(docs, benchmark)).where(F.size(F.col(f"`{mark}`.spans")) == 0).drop(mark)
