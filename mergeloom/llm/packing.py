"""Packing documents into sequences by order-preserving dynamic programming.

Documents are ranged by doc_id and encoded; each partition's token stream is
cut into windows of at most `SEQUENCE` tokens. Where a window may end:

* after a document (no penalty),
* after a sentence (`SENTENCE_PENALTY`),
* at every `GRID` tokens inside a document (`CUT_PENALTY`), so that sentences of any length fit.

With the places in order, cost(e) = SEQUENCE + penalty(e) + min cost(s) over
e - SEQUENCE <= s < e: padding plus truncation penalties up to a constant. A
monotone queue of open window starts gives each minimum in amortised constant time. Ties take the earliest start.

Each partition ends with one window that may be short. Sequences are numbered by partition, then in order.

Edge cases: null text is an empty document, that is one end token. A null
doc_id sorts first. Rows that repeat a doc_id are packed each, one after the other. An empty
table gives no pieces. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import give_back, text_of
from .encoding import Encoder, tokenizer_path

SEQUENCE = 2048
GRID = 32
SENTENCE_PENALTY = 4
CUT_PENALTY = 24
END_ID = 1
#: The stream is cut at a document's end once it holds this many tokens.
STREAM_TOKENS = 1 << 22
#: Pieces that leave a task at once, of 8 kB of ids each at most.
PIECES_AT_ONCE = 128
SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, ids binary"
)


def cut_places(stream: np.ndarray, ends: np.ndarray, encoder: Encoder) -> tuple[np.ndarray, np.ndarray]:
    """Places where a window may end, ascending, and their penalties; documents end at `ends`."""
    now, after = stream[:-1], stream[1:]
    sentences = np.flatnonzero(encoder.ends_line[now] | (encoder.ends_sentence[now] & encoder.starts_space[after])) + 1
    grid = np.arange(GRID, ends[-1], GRID)
    places = np.concatenate([ends, sentences, grid])
    costs = np.repeat([0, SENTENCE_PENALTY, CUT_PENALTY], [len(ends), len(sentences), len(grid)])
    order = np.lexsort((costs, places))
    places, costs = places[order], costs[order]
    first = np.concatenate([[True], places[1:] != places[:-1]])
    return places[first], costs[first]


def best_cuts(places: list[int], costs: list[int], limit: int) -> list[int]:
    """Window ends of least total cost; the last place is the last end."""
    at, total, came = [0, *places], [0], [0]
    queue: deque[int] = deque([0])
    for i, (place, cost) in enumerate(zip(places, costs), 1):
        while at[queue[0]] < place - limit:
            queue.popleft()
        start = queue[0]
        here = total[start] + limit + cost
        total.append(here)
        came.append(start)
        while queue and total[queue[-1]] > here:
            queue.pop()
        queue.append(i)
    out, i = [], len(places)
    while i:
        out.append(at[i])
        i = came[i]
    return out[::-1]


def _pieces(ids: list[int | None], documents: list[np.ndarray], encoder: Encoder, first: int) -> tuple[pa.RecordBatch, int]:
    """The pieces of a stream of documents, whose list is emptied, and the next window's number."""
    sizes = np.array([len(d) for d in documents])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    stream = np.concatenate(documents).astype(np.int32, copy=False).view("<u4")
    documents.clear()
    places, costs = cut_places(stream, ends, encoder)
    cuts = best_cuts(places.tolist(), costs.tolist(), SEQUENCE)
    edges = np.unique(np.concatenate([[0], ends, cuts]))
    a, b = edges[:-1], edges[1:]
    doc = np.searchsorted(ends, a, "right")
    window = np.searchsorted(cuts, a, "right")
    opened = np.concatenate([[0], cuts])[window]
    raw = pa.Array.from_buffers(pa.binary(), len(a), [None, pa.py_buffer((4 * edges).astype(np.int32)), pa.py_buffer(stream)])
    columns = [
        pa.array([ids[d] for d in doc], pa.int64()),
        pa.array(a - starts[doc], pa.int64()),
        pa.array(b - a, pa.int64()),
        pa.array([zlib.crc32(stream[x:y]) for x, y in zip(a, b)], pa.int64()),
        pa.array(sizes[doc], pa.int64()),
        pa.array(first + window, pa.int64()),
        pa.array(a - opened, pa.int64()),
        raw,
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]), first + len(cuts)


def pack(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """One row per piece of a document in a sequence; `ids` holds its token ids
    as little-endian unsigned 32-bit."""
    path = vocabulary or tokenizer_path()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.cached(path)
        number = TaskContext.get().partitionId() << 40
        ids, documents, size = [], [], 0

        def cut() -> Iterator[pa.RecordBatch]:
            nonlocal ids, size, number
            out, number = _pieces(ids, documents, encoder, number)
            ids, size = [], 0
            for first in range(0, out.num_rows, PIECES_AT_ONCE):
                yield out.slice(first, PIECES_AT_ONCE)

        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1)):
                ids.append(name.as_py())
                documents.append(np.append(encoder.encode(text.as_py()), np.int32(END_ID)))
                size += len(documents[-1])
                if size >= STREAM_TOKENS:
                    yield from cut()
        batch = None
        if documents:
            yield from cut()
        give_back()

    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), text_of(docs).alias("text"))
    return rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id").mapInArrow(packed, SCHEMA)
