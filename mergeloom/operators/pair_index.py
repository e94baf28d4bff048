"""Which chunks hold a pair: an index stored by pair, and count changes from the chunks it names.

An index row is (pair, tokens, cnt, rank): a chunk as it stood when the index was written, once for each wanted
pair in it. A chunk's rows are written by the task that reads the chunk, in runs sorted by pair, so reading a few pairs' chunks
skips all but a few pages of each run, and no row is shuffled or spilled. Merges made since are applied to what is read.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import pairwise
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.ragged import (
    MergeRanks, changed_totals, combined_totals, list_rows, listed_pairs, merge_rows, row_owners, take_rows, to_list_array, weight_cuts,
)
from ..session import new_path

Pair = tuple[int, int]

_SCHEMA = "pair long, tokens array<int>, cnt long, rank long"
# Rows and tokens that a run sorted by pair has at most, but for the rows of a last batch.
_RUN_ROWS = 1 << 18
_RUN_TOKENS = 1 << 22
# Tokens written at once.
_SLICE_TOKENS = 1 << 18
# Rows to a page: what is skipped or read at once.
_PAGE_ROWS = 1000
# From so many keys on, Spark looks keys up in a set, and its compiled code doesn't differ from round to round.
_LEAST_KEYS = 16
_TOLD = ["pair", "cnt", "rank", "index", "after"]
# Under this key a task tells how many chunks it read.
_READ = -1


def pair_key(pair: Pair) -> int:
    return pair[0] << 32 | pair[1]


def key_pair(key: int) -> Pair:
    return key >> 32, key & 0xFFFFFFFF


@dataclass(frozen=True)
class Change:
    """What a round does to a pair: change of its count, and its least place in
    the chunks that were read, before and after (None where it isn't in them)."""

    cnt: int
    before: int | None
    after: int | None


class PairIndex:
    """Chunks by pair. `first_id` is the first id that no chunk holds yet."""

    def __init__(self, state: DataFrame, pairs: list[Pair], first_id: int) -> None:
        self.spark, self.first_id = state.sparkSession, first_id
        self.path = new_path(self.spark, "pair-index")
        wanted = np.sort(np.array([pair_key(p) for p in pairs], np.int64))

        def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, n_rows, n_tokens = [], 0, 0
            for batch in batches:
                values, lengths = list_rows(batch.column("tokens"))
                rest = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("cnt", "rank")]
                rows, keys = listed_pairs(values, lengths, wanted)
                held.append((values, lengths, *rest, rows, keys))
                n_rows, n_tokens = n_rows + len(rows), n_tokens + len(values)
                if n_rows >= _RUN_ROWS or n_tokens >= _RUN_TOKENS:
                    yield from run(held)
                    held, n_rows, n_tokens = [], 0, 0
            if held:
                yield from run(held)

        def run(held) -> Iterator[pa.RecordBatch]:
            before = np.cumsum([0, *(len(part[1]) for part in held)])
            values, lengths, cnt, rank, rows, keys = (np.concatenate(c) for c in zip(*held))
            rows = rows + np.repeat(before[:-1], [len(part[4]) for part in held])
            order = np.argsort(keys, kind="stable")
            rows, keys = rows[order], keys[order]
            starts = np.cumsum(lengths) - lengths
            # A chunk is repeated for each of its pairs: some tokens at a time.
            for a, b in pairwise(weight_cuts(lengths[rows], _SLICE_TOKENS)):
                some = rows[a:b]
                tokens = to_list_array(*take_rows(values, lengths, some, starts))
                columns = [pa.array(keys[a:b]), tokens, pa.array(cnt[some]), pa.array(rank[some])]
                yield pa.RecordBatch.from_arrays(columns, names=["pair", "tokens", "cnt", "rank"])

        rows = state.select("tokens", "cnt", "rank").mapInArrow(listed, _SCHEMA)
        rows.write.option("parquet.page.row.count.limit", str(_PAGE_ROWS)).parquet(self.path)
        reader = self.spark.newSession()
        # By default more than ten keys reach the scan as one range.
        reader.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", str(1 << 20))
        self.rows = reader.read.schema(_SCHEMA).parquet(self.path)

    def chunks(self, pairs: list[Pair]) -> DataFrame:
        """(pair, tokens, cnt, rank) of the pairs' chunks, read by pushed-down filters."""
        absent = range(-2, -2 - max(0, _LEAST_KEYS - len(pairs)), -1)
        return self.rows.where(F.col("pair").isin(*[pair_key(p) for p in pairs], *absent))

    def changes(
        self, roots: list[Pair], made: list[Pair], run: list[Pair], wanted: list[Pair], least: int
    ) -> tuple[dict[Pair, Change], int]:
        """(changes by pair, chunks read) of merging `run` after the merges `made`.

        `roots` are indexed pairs such that every chunk concerned holds one. Told are
        changes of the `wanted` pairs, and pairs with a token of the run that occur
        `least` times. Without a run, `after` and the count of the wanted pairs are told.

        Each task adds up what it reads, and tells no more than a row per pair: the driver adds them up.
        """
        next_id = self.first_id + len(made)
        first_id, keys = self.first_id, np.sort(np.array([pair_key(p) for p in wanted], np.int64))
        # Places count tokens as of the index: the length of what each later id stands for.
        widths = np.ones(next_id + len(run), np.int64)
        for i, (left, right) in enumerate([*made, *run]):
            widths[first_id + i] = widths[left] + widths[right]

        def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            order, told, read = MergeRanks(roots, 0), [], 0
            before, now = MergeRanks(made, first_id), MergeRanks(run, next_id)
            for batch in batches:
                values, lengths = list_rows(batch.column("tokens"))
                pairs, weights, ranks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("pair", "cnt", "rank"))
                if len(roots) > 1:
                    # A chunk that several roots name is worked on once, under the first of them.
                    own = np.flatnonzero(row_owners(values, lengths, order) == order.lookup(pairs >> 32, pairs & 0xFFFFFFFF))
                    values, lengths = take_rows(values, lengths, own)
                    weights, ranks = weights[own], ranks[own]
                read += len(lengths)
                old = merge_rows(values, lengths, before)
                new = merge_rows(*old, now) if len(run) else None
                told.append(changed_totals(old, new, weights, ranks, widths, keys, next_id))
            if read:
                totals = [np.append(t, x) for t, x in zip(combined_totals(told), (_READ, read, 0, 0, 0))]
                yield pa.RecordBatch.from_arrays([pa.array(t) for t in totals], names=_TOLD)

        found = self.chunks(roots).mapInArrow(change, ", ".join(f"{c} long" for c in _TOLD)).toArrow()
        totals = combined_totals([[found[c].to_numpy() for c in _TOLD]])
        changes: dict[int, Change] = {}
        for key, cnt, rank, index, after in zip(*(t.tolist() for t in totals)):
            # As one number, places order like (rank, index).
            place, old = rank << 31 | index, changes.get(key)
            if after:
                changes[key] = Change(cnt + (old.cnt if old else 0), old.before if old else None, place)
            else:
                changes[key] = Change(cnt, place, None)
        read = changes.pop(_READ, Change(0, None, None)).cnt
        fresh = lambda pair: max(pair) >= next_id
        out = {key_pair(k): c for k, c in changes.items()}
        return {p: c for p, c in out.items() if not fresh(p) or c.cnt >= least}, read
