"""Byte-pair merging of many short token rows at once, on Arrow buffers.

Used inside tasks only: Spark decides which rows a batch holds.
"""

from __future__ import annotations

import itertools
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_NONE = np.iinfo(np.int64).max
# Rows of more tokens are merged as linked lists, by rank.
LONG_ROW = 512
# Bytes of text whose tokens are worked on at once.
SLICE_BYTES = 1 << 20


class MergeRanks:
    """Sorted pair keys with their ranks; lookups are one binary search."""

    def __init__(self, merges, first_id: int = 256):
        pairs = np.array(merges, dtype=np.int64).reshape(-1, 2)
        keys = (pairs[:, 0] << 32) | pairs[:, 1]
        order = np.argsort(keys, kind="stable")
        self.pairs = pairs
        self.keys = keys[order]
        self.ranks = order.astype(np.int64)
        self.first_id = first_id

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(left), _NONE)
        key = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)


def merge_rows(values: np.ndarray, lengths: np.ndarray, table: MergeRanks):
    """Encode every row: (values, lengths) of byte tokens to merged tokens."""
    long = lengths > LONG_ROW
    if not long.any():
        return _merge_short(values, lengths, table)
    kinds = []
    for rows, merge in ((np.flatnonzero(~long), _merge_short), (np.flatnonzero(long), _merge_long)):
        kinds.append((rows, *merge(*take_rows(values, lengths, rows), table)))
    rows, out, sizes = (np.concatenate(x) for x in zip(*kinds))
    back = np.argsort(rows, kind="stable")
    return take_rows(out, sizes, back)


def _merge_long(values: np.ndarray, lengths: np.ndarray, table: MergeRanks):
    """`merge_rows` in n log n steps: tokens are a doubly linked list, and places wait in a heap by the rank of
    their pair. A merge only makes pairs of higher rank, so each rank comes up once, with all its places."""
    n, values = len(values), values.astype(np.int32)
    row = np.repeat(np.arange(len(lengths)), lengths)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    ends = np.cumsum(lengths)
    after[ends[lengths > 0] - 1] = -1
    before[(ends - lengths)[lengths > 0]] = -1
    alive = np.ones(n, bool)
    waiting: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def enter(places: np.ndarray) -> None:
        ranks = table.lookup(values[places], values[after[places]])
        known = np.flatnonzero(ranks != _NONE)
        order = known[np.argsort(ranks[known], kind="stable")]
        if not len(order):
            return
        sorted_ranks = ranks[order]
        cuts = np.flatnonzero(sorted_ranks[1:] != sorted_ranks[:-1]) + 1
        for rank, part in zip(sorted_ranks[np.r_[0, cuts]].tolist(), np.split(places[order], cuts)):
            if rank not in waiting:
                waiting[rank] = []
                heappush(heap, rank)
            waiting[rank].append(part)

    enter(np.flatnonzero(after >= 0))
    while heap:
        rank = heappop(heap)
        parts = waiting.pop(rank)
        places = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
        left, right = table.pairs[rank]
        # Places may have been merged away, or have another neighbour by now.
        places = places[alive[places] & (values[places] == left) & (after[places] >= 0)]
        places = places[values[after[places]] == right]
        if left == right and len(places):
            # Of overlapping places, every second one counted from the left.
            begins = np.flatnonzero(np.r_[True, after[places[:-1]] != places[1:]])
            nth = np.arange(len(places)) - np.repeat(begins, np.diff(np.r_[begins, len(places)]))
            places = places[nth % 2 == 0]
        if not len(places):
            continue
        gone = after[places]
        values[places] = table.first_id + rank
        alive[gone] = False
        beyond = after[gone]
        after[places] = beyond
        inside = beyond >= 0
        before[beyond[inside]] = places[inside]
        previous = before[places]
        enter(np.unique(np.r_[previous[previous >= 0], places[inside]]))
    return values[alive], np.bincount(row[alive], minlength=len(lengths)).astype(np.int64)


def _merge_short(values: np.ndarray, lengths: np.ndarray, table: MergeRanks):
    """Each pass merges, in every unfinished row, all occurrences of that row's
    lowest-ranked pair from left to right, and sets finished rows aside.
    """
    row = np.repeat(np.arange(len(lengths)), lengths)
    values = values.astype(np.int32)
    done_rows, done_values = [], []
    while len(values):
        starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        rank = np.full(len(values), _NONE)
        inside = np.flatnonzero(row[1:] == row[:-1])
        rank[inside] = table.lookup(values[inside], values[inside + 1])
        best = np.minimum.reduceat(rank, starts)
        sizes = np.diff(np.r_[starts, len(values)])
        live = np.repeat(best != _NONE, sizes)
        if not live.all():
            done_rows.append(row[~live])
            done_values.append(values[~live])
            best = np.repeat(best, sizes)[live]
            row, values, rank = row[live], values[live], rank[live]
        else:
            best = np.repeat(best, sizes)
        hits = np.flatnonzero((rank == best) & (rank != _NONE))
        if not len(hits):
            continue
        # Hits next to each other overlap (a pair of equal tokens): keep every
        # second one, counted from the start of the run.
        fresh = np.r_[True, np.diff(hits) != 1]
        run_start = hits[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
        hits = hits[(hits - run_start) % 2 == 0]
        values[hits] = table.first_id + rank[hits]
        keep = np.ones(len(values), dtype=bool)
        keep[hits + 1] = False
        row, values = row[keep], values[keep]
    if not done_rows:
        return np.empty(0, np.int32), np.zeros(len(lengths), np.int64)
    all_rows, all_values = np.concatenate(done_rows), np.concatenate(done_values)
    order = np.argsort(all_rows, kind="stable")
    return all_values[order], np.bincount(all_rows, minlength=len(lengths)).astype(np.int64)


def encode_strings(chunks: pa.Array, table: MergeRanks, specials: dict[str, int]):
    """(values, lengths) of token ids for an Arrow string array."""
    chunks = chunks.cast(pa.large_binary())
    offsets = np.frombuffer(chunks.buffers()[1], dtype=np.int64)[chunks.offset :][: len(chunks) + 1]
    data = chunks.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    raw = raw[offsets[0] : offsets[-1]] if len(offsets) else raw
    lengths = np.diff(offsets)
    if specials:
        known = {token.encode("utf-8"): i for token, i in specials.items()}
        longest = max(map(len, known))
        candidates = np.flatnonzero((lengths > 0) & (lengths <= longest))
        found = {}
        for at in candidates:
            special = known.get(chunks[int(at)].as_py())
            if special is not None:
                found[int(at)] = special
        if found:
            # A special is one token: blank its bytes, then put the id in.
            base = np.cumsum(lengths) - lengths
            keep = np.ones(len(raw), dtype=bool)
            marked = raw.astype(np.int32)
            for at, token_id in found.items():
                keep[base[at] + 1 : base[at] + lengths[at]] = False
                marked[base[at]] = token_id
                lengths[at] = 1
            return merge_rows(marked[keep], lengths, table)
    return merge_rows(raw, lengths, table)


def weight_cuts(weights: np.ndarray, limit: int) -> list[int]:
    """Ascending cuts 0..n: stretches of rows that weigh at most `limit`, or a single row that weighs more."""
    ends = np.cumsum(weights)
    cuts = [0]
    while cuts[-1] < len(weights):
        before = ends[cuts[-1] - 1] if cuts[-1] else 0
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(ends, before + limit, "right"))))
    return cuts


def byte_lengths(strings: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(strings), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def encode_lists(lists: pa.ListArray, table: MergeRanks, specials: dict[str, int], slice_bytes: int = SLICE_BYTES):
    """(first row, token lists) of stretches of rows of chunk lists, in order; a null row has no tokens.

    The distinct chunks are encoded once. Their tokens are dealt out to a stretch of some bytes of text at a time,
    and inside of a long row to a stretch of its chunks, so what is held beside the
    batch and one stretch's tokens doesn't grow with the batch.
    """
    flat = lists.flatten().dictionary_encode()
    coded, sizes = [], []
    for a, b in itertools.pairwise(weight_cuts(byte_lengths(flat.dictionary), slice_bytes)):
        values, lengths = encode_strings(flat.dictionary.slice(a, b - a), table, specials)
        coded.append(values.astype(np.int32))
        sizes.append(lengths)
    values, lengths = np.concatenate(coded or [np.empty(0, np.int32)]), np.concatenate(sizes or [np.empty(0, np.int64)])
    del coded, sizes
    starts = np.cumsum(lengths) - lengths
    picks = flat.indices.to_numpy(zero_copy_only=False)
    ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    n_tokens = np.r_[0, np.cumsum(lengths[picks])] if len(picks) else np.zeros(1, np.int64)
    totals = np.diff(np.r_[0, n_tokens[ends]])
    cuts = weight_cuts(totals, slice_bytes)
    for a, b in itertools.pairwise(cuts):
        first, last = ends[a - 1] if a else 0, ends[b - 1]
        own = picks[first:last]
        out = np.empty(n_tokens[last] - n_tokens[first], np.int32)
        at = 0
        for c, d in itertools.pairwise(weight_cuts(lengths[own], slice_bytes)):
            part, _ = take_rows(values, lengths, own[c:d], starts)
            out[at : at + len(part)] = part
            at += len(part)
        yield a, to_list_array(out, totals[a:b])


def list_rows(column: pa.ListArray):
    """(values, lengths) of an Arrow list<int32> column without NULLs."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), lengths


def _adjacent(values: np.ndarray, lengths: np.ndarray):
    """(at, row, key) of every adjacent pair; key is left << 32 | right."""
    row = np.repeat(np.arange(len(lengths)), lengths)
    at = np.flatnonzero(row[1:] == row[:-1])
    return at, row[at], (values[at].astype(np.int64) << 32) | values[at + 1]


def _known(keys: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(keys), bool)
    return ordered[np.minimum(np.searchsorted(ordered, keys), len(ordered) - 1)] == keys


def listed_pairs(values: np.ndarray, lengths: np.ndarray, wanted: np.ndarray):
    """(row, key) of the distinct pairs of each row that are in `wanted` (sorted)."""
    _, row, key = _adjacent(values, lengths)
    hit = _known(key, wanted)
    row, key = row[hit], key[hit]
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
    return row[fresh], key[fresh]


def row_owners(values: np.ndarray, lengths: np.ndarray, table: MergeRanks) -> np.ndarray:
    """The least rank of any pair in each row; no row is empty."""
    if not len(lengths):
        return np.empty(0, np.int64)
    ranks = np.full(len(values), _NONE)
    ranks[:-1] = table.lookup(values[:-1], values[1:])
    ends = np.cumsum(lengths)
    ranks[ends - 1] = _NONE  # pairs do not reach over rows
    return np.minimum.reduceat(ranks, ends - lengths)


def pair_totals(values, lengths, weights, ranks, widths=None):
    """(key, cnt, rank, index) of the adjacent pairs in one batch of rows.

    key is left << 32 | right; cnt sums the weights of the rows, counting each
    overlapping occurrence; (rank, index) is the least place of the pair. With
    `widths` by id, index adds up the widths of the tokens before.
    """
    if len(ranks) and (np.diff(ranks) < 0).any():
        by_rank = np.argsort(ranks, kind="stable")
        values, lengths = take_rows(values, lengths, by_rank)
        weights, ranks = weights[by_rank], ranks[by_rank]
    at, row, key = _adjacent(values, lengths)
    if not len(at):
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty
    # A stable sort leaves each pair's places in order.
    order = np.argsort(key, kind="stable")
    key, owner = key[order], row[order]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    cnt = np.add.reduceat(weights[owner], starts)
    first = owner[starts]
    before = np.arange(len(values) + 1) if widths is None else np.r_[0, np.cumsum(widths[values])]
    index = before[at[order[starts]]] - before[np.cumsum(lengths) - lengths][first]
    return key[starts], cnt, ranks[first], index


def changed_totals(old, new, weights, ranks, widths, keys, next_id):
    """(key, cnt, rank, index, after): totals of `old` rows, counted down, and of `new` ones.

    Only pairs in `keys` (sorted), and pairs with an id from `next_id` on, are told; rows
    and pairs that are the same in both aren't. Without `new`, totals of `old` are told as if new.
    """
    if new is None:
        totals = pair_totals(*old, weights, ranks, widths)
        wanted = _known(totals[0], keys)
        return (*(t[wanted] for t in totals), np.ones(int(wanted.sum()), np.int64))
    touched = np.flatnonzero(old[1] != new[1])  # a merge shortens its row
    weights, ranks = weights[touched], ranks[touched]
    parts = []
    for after, rows in enumerate((old, new)):
        key, cnt, rank, index = pair_totals(*take_rows(*rows, touched), weights, ranks, widths)
        wanted = _known(key, keys) | (key >> 32 >= next_id) | (key & 0xFFFFFFFF >= next_id)
        parts.append([t[wanted] for t in (key, cnt if after else -cnt, rank, index, np.full(len(key), after))])
    lost, won = parts
    _, a, b = np.intersect1d(lost[0], won[0], assume_unique=True, return_indices=True)
    same = (lost[1][a] == -won[1][b]) & (lost[2][a] == won[2][b]) & (lost[3][a] == won[3][b])
    return tuple(np.r_[np.delete(x, a[same]), np.delete(y, b[same])] for x, y in zip(lost, won))


def combined_totals(parts):
    """Totals (key, cnt, rank, index, after) of several batches as one per (key, after), ordered by it."""
    if not parts:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    key, cnt, rank, index, after = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((index, rank, after, key))
    key, cnt, rank, index, after = (c[order] for c in (key, cnt, rank, index, after))
    starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (after[1:] != after[:-1])]) if len(key) else np.empty(0, np.int64)
    sums = np.add.reduceat(cnt, starts) if len(key) else cnt
    return key[starts], sums, rank[starts], index[starts], after[starts]


def take_rows(values: np.ndarray, lengths: np.ndarray, picks: np.ndarray, starts: np.ndarray | None = None):
    """Concatenate the picked rows of a ragged array; `starts` of its rows where they are known."""
    starts = np.cumsum(lengths) - lengths if starts is None else starts
    out_lengths = lengths[picks]
    shift = np.repeat(starts[picks] - (np.cumsum(out_lengths) - out_lengths), out_lengths)
    return values[np.arange(len(shift)) + shift], out_lengths


def gathered_rows(values: np.ndarray, lengths: np.ndarray, picks: np.ndarray, starts: np.ndarray):
    """`take_rows`, a stretch of the picked rows at a time: places are held for one stretch only."""
    out_lengths = lengths[picks]
    out, at = np.empty(int(out_lengths.sum()), values.dtype), 0
    for a, b in itertools.pairwise(weight_cuts(out_lengths, SLICE_BYTES)):
        part, _ = take_rows(values, lengths, picks[a:b], starts)
        out[at : at + len(part)] = part
        at += len(part)
    return out, out_lengths


def to_list_array(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    offsets = np.r_[0, np.cumsum(lengths)]
    if offsets[-1] > np.iinfo(np.int32).max:
        raise OverflowError("a batch of over 2^31 tokens: lower spark.sql.execution.arrow.maxRecordsPerBatch")
    offsets = offsets.astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32, copy=False)))


def varints(values: np.ndarray):
    """(bytes, sizes) of numbers below 2^35 in stretches of seven bits, the lowest first; small numbers take one byte."""
    values = values.astype(np.int64, copy=False)
    sizes = 1 + sum((values >> bits > 0).astype(np.int64) for bits in (7, 14, 21, 28))
    starts = np.cumsum(sizes) - sizes
    raw = np.empty(int(sizes.sum()), np.uint8)
    for i in range(int(sizes.max(initial=0))):
        some = np.flatnonzero(sizes > i)
        raw[starts[some] + i] = (values[some] >> 7 * i & 127) | ((sizes[some] > i + 1) << 7)
    return raw, sizes


def read_varints(raw: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(raw < 128)
    starts = np.r_[0, ends[:-1] + 1] if len(ends) else ends
    values, sizes = np.zeros(len(ends), np.int64), ends - starts + 1
    for i in range(int(sizes.max(initial=0))):
        some = np.flatnonzero(sizes > i)
        values[some] |= (raw[starts[some] + i].astype(np.int64) & 127) << 7 * i
    return values


def binary_array(raw: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.r_[0, np.cumsum(sizes)].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


def binary_rows(column: pa.Array):
    """(bytes, sizes) of an Arrow binary column without NULLs."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], np.diff(offsets)


class ChunkBlock:
    """Lists of chunks as numbers: the distinct chunks of all lists that were added, the most frequent first."""

    def __init__(self):
        self.parts, self.bytes = [], 0

    def add(self, lists: pa.ListArray, *rest) -> None:
        """`rest` comes back with the lists' numbers."""
        flat = lists.flatten()
        self.bytes += int(byte_lengths(flat).sum())
        flat = flat.dictionary_encode()
        lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.parts.append((flat.dictionary, flat.indices.to_numpy(zero_copy_only=False).copy(), lengths, rest))

    def finish(self):
        """(chunks, parts): a part is an iterator of its lists' numbers (first row, varints, as many as rows), and its rest."""
        merged = pa.concat_arrays([part[0] for part in self.parts]).dictionary_encode()
        known = np.split(merged.indices.to_numpy(zero_copy_only=False), np.cumsum([len(part[0]) for part in self.parts])[:-1])
        counts = np.zeros(len(merged.dictionary), np.int64)
        for own, (_, indices, _, _) in zip(known, self.parts):
            counts[own] += np.bincount(indices, minlength=len(own))
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        return merged.dictionary.take(pa.array(order)), [
            (self._numbers(rank[own], indices, lengths), rest) for own, (_, indices, lengths, rest) in zip(known, self.parts)
        ]

    @staticmethod
    def _numbers(codes: np.ndarray, indices: np.ndarray, lengths: np.ndarray):
        ends = np.cumsum(lengths)
        for a, b in itertools.pairwise(weight_cuts(lengths, SLICE_BYTES)):
            raw, sizes = varints(codes[indices[ends[a] - lengths[a] : ends[b - 1]]])
            before = np.r_[0, np.cumsum(sizes)]
            last = ends[a:b] - ends[a] + lengths[a]
            yield a, binary_array(raw, before[last] - before[last - lengths[a:b]])


def packed_ids(codes: np.ndarray, values: np.ndarray, lengths: np.ndarray) -> bytes:
    """Token rows of ascending numbers, for `IdTable.add`."""
    return varints(np.r_[len(codes), np.diff(codes, prepend=0), lengths, values])[0].tobytes()


class IdTable:
    """Token rows by number, from packs in any order."""

    def __init__(self):
        self.packs, self.ready = [], None

    def add(self, pack: np.ndarray) -> None:
        numbers = read_varints(pack)
        n = int(numbers[0])
        self.packs.append((np.cumsum(numbers[1 : n + 1]), numbers[n + 1 : 2 * n + 1], numbers[2 * n + 1 :].astype(np.int32)))

    def rows(self):
        """(values, lengths, starts), the last two by number."""
        if self.ready is None:
            codes, lengths, values = (np.concatenate(c) for c in zip(*self.packs)) if self.packs else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32))
            size, at = int(codes.max(initial=-1)) + 1, np.cumsum(lengths) - lengths
            by_code = np.zeros((2, size), np.int64)
            by_code[0, codes], by_code[1, codes] = lengths, at
            self.packs, self.ready = [], (values, *by_code)
        return self.ready


def next_in_chain(groups: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether each row but the last ends where the next one begins, in the same group."""
    return (groups[1:] == groups[:-1]) & (starts[:-1] + lengths[:-1] == starts[1:])


def shifted_rows(values: np.ndarray, lengths: np.ndarray, follows: np.ndarray) -> pa.ListArray:
    """Every value's successor in its row; a row's last one has the next row's first
    value where that `follows`, else null. No row is empty."""
    ends = np.cumsum(lengths)
    successors = np.r_[values[1:], 0].astype(np.int32)
    missing = np.zeros(len(values), bool)
    missing[ends[~follows] - 1] = True
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(successors, mask=missing))


def with_successor(batches):
    """(batch, last): each batch but the last one ends with the row before the next one begins; that
    row with the next batch, so that every row but the last has its successor beside it."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        if batch.num_rows > 1:
            yield batch, False
        held = batch.slice(batch.num_rows - 1)
    if held is not None:
        yield held, True
