"""Byte-pair training as Spark jobs over the chunk dictionary.

State is a table (tokens, cnt, rank): distinct chunks as token arrays, their
weight, and their position in corpus order. Pairs are counted once; from then on
counts are carried from round to round:

* The best pairs (at most `_LEADERS`) are held with their counts and first places, and an index
  stored by pair names the chunks that hold each of them (`pair_index`).
* A round merges a run of pairs. One job reads the chunks the index names for them and adds up
  signed changes of counts and places; no other chunk is read.
* Counts of pairs only fall, but for pairs with a new id, which that job counts in full. So a
  pair that isn't held stays behind the best one that was left out. When the best pair held
  falls behind that one too, the merges made are written into the state, and pairs are counted and indexed anew.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from heapq import nsmallest
from itertools import takewhile
from typing import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import ragged
from ..functions.codes import byte_codes, code_ids
from ..functions.ragged import MergeRanks, list_rows, merge_rows, pair_totals, to_list_array
from ..session import cut_lineage
from .dictionary import corpus_position
from .pair_index import Change, Pair, PairIndex
from .tokenizer import FIRST_MERGE_ID, Tokenizer

cloudpickle.register_pickle_by_value(ragged)

# Pairs held with their counts; four times as many before the last ones are let go.
_LEADERS = 2048
# Best pairs from which a round's run is taken.
_RUN = 128

TRACE_SCHEMA = T.StructType(
    [
        T.StructField("rank", T.IntegerType(), False),
        T.StructField("left", T.IntegerType(), False),
        T.StructField("right", T.IntegerType(), False),
        T.StructField("id", T.IntegerType(), False),
        T.StructField("bytes", T.BinaryType(), False),
        T.StructField("cnt", T.LongType(), False),
    ]
)


@dataclass(frozen=True)
class Training:
    tokenizer: Tokenizer
    counts: tuple[int, ...]
    rounds: int
    # Per round: merges, and chunks read for them.
    merged: tuple[int, ...] = ()
    touched: tuple[int, ...] = ()
    # How often pairs were counted and indexed.
    epochs: int = 0

    def trace(self, spark: SparkSession) -> DataFrame:
        """One row per merge: pair, new id, bytes and the winning count."""
        vocab = self.tokenizer.vocab
        rows = [
            (rank, left, right, FIRST_MERGE_ID + rank, vocab[FIRST_MERGE_ID + rank], cnt)
            for rank, ((left, right), cnt) in enumerate(zip(self.tokenizer.merges, self.counts))
        ]
        return spark.createDataFrame(rows, TRACE_SCHEMA)


def training_state(dictionary: DataFrame) -> DataFrame:
    """Stored (tokens, cnt, rank), rank being the dense first-seen order.

    One range shuffle. The stored partition number and the row number inside
    it give the dense rank without a global window.
    """
    # A fixed partition count keeps every later round as parallel as the cluster.
    parts = int(dictionary.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        dictionary.filter(F.octet_length("chunk") > 1)
        .repartitionByRange(parts, "first_doc", "first_idx")
        .sortWithinPartitions("first_doc", "first_idx")
        .select(
            code_ids(byte_codes("chunk")).alias("tokens"),
            "cnt",
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("row"),
        )
    )
    stored = cut_lineage(ordered, "chunk-order")
    sizes = {r["part"]: r["n"] for r in stored.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, total = [], 0
    for part in range(max(sizes, default=-1) + 1):
        starts.append(total)
        total += sizes.get(part, 0)
    offset = F.get(F.from_json(F.lit(str(starts)), "array<bigint>"), F.col("part"))
    return stored.select("tokens", "cnt", (offset + F.col("row")).alias("rank"))


def pair_counts(state: DataFrame, merges=(), first_id: int = FIRST_MERGE_ID) -> DataFrame:
    """(left, right, cnt, first) after applying `merges` to the state.

    Every Arrow batch is reduced to its distinct pairs before Spark combines
    and shuffles them, so a round moves pair counts and never chunks. `first`
    orders corpus positions, whatever their number and the chunks' lengths.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = MergeRanks(merges, first_id)
        for batch in batches:
            values, lengths = list_rows(batch.column("tokens"))
            if len(merges):
                values, lengths = merge_rows(values, lengths, table)
            weights, ranks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cnt", "rank"))
            totals = pair_totals(values, lengths, weights, ranks)
            yield pa.RecordBatch.from_arrays([pa.array(t) for t in totals], names=["pair", "cnt", "rank", "index"])

    partial = state.select("tokens", "cnt", "rank").mapInArrow(count, "pair long, cnt long, rank long, index long")
    first = F.min(corpus_position(F.col("rank"), F.col("index")))
    totals = partial.groupBy("pair").agg(F.sum("cnt").alias("cnt"), first.alias("first"))
    return totals.select(
        F.shiftright("pair", 32).cast("int").alias("left"),
        F.col("pair").bitwiseAND((1 << 32) - 1).cast("int").alias("right"),
        "cnt",
        "first",
    )


def advance(state: DataFrame, merges, first_id: int) -> DataFrame:
    """The state with `merges` applied; chunks that became a single token are
    left out, they can never form a pair again."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = MergeRanks(merges, first_id)
        for batch in batches:
            tokens = to_list_array(*merge_rows(*list_rows(batch.column("tokens")), table))
            rest = [batch.column(c) for c in ("cnt", "rank")]
            yield pa.RecordBatch.from_arrays([tokens, *rest], names=["tokens", "cnt", "rank"])

    merged = state.select("tokens", "cnt", "rank").mapInArrow(
        merge, "tokens array<int>, cnt long, rank long"
    )
    return merged.filter(F.size("tokens") > 1)


def best_pairs(counts: DataFrame, n: int) -> DataFrame:
    """Most frequent first, ties to the pair seen first."""
    return counts.orderBy(F.desc("cnt"), F.asc("first")).limit(n)


def independent_prefix(ranked: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Longest safe run of best pairs `(left, right, cnt)` to merge at once.

    Merging (a,b) takes occurrences away only from pairs that end in a or start
    with b, and each pair it creates occurs at most as often, and first appears
    no earlier, than such a pair. So as long as no pair in the run ends in an
    accepted left or starts with an accepted right, one-at-a-time training
    would pick exactly this run. After (a,a) the new pairs are bounded only by
    (a,a) itself, so the run ends there.
    """
    run: list[tuple[int, int, int]] = []
    lefts: set[int] = set()
    rights: set[int] = set()
    for left, right, cnt in ranked:
        if right in lefts or left in rights:
            break
        run.append((left, right, cnt))
        if left == right:
            break
        lefts.add(left)
        rights.add(right)
    return run


@dataclass
class _Held:
    cnt: int
    first: int
    # Whether `first` is the first place, or a place that the first one isn't before.
    exact: bool = True

    @property
    def key(self) -> tuple[int, int]:
        return -self.cnt, self.first


@dataclass
class _Epoch:
    """Pairs held since they were last counted, and the merges made since."""

    state: DataFrame
    first_id: int
    held: dict[Pair, _Held] = field(default_factory=dict)
    made: list[Pair] = field(default_factory=list)
    # Tokens, as of the index, of ids made since.
    spelled: dict[int, tuple[int, ...]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        rows = best_pairs(pair_counts(self.state), _LEADERS + 1).collect()
        found = [((r["left"], r["right"]), _Held(r["cnt"], int(r["first"]))) for r in rows]
        # Every pair that isn't held comes at or after this key.
        self.limit = found[_LEADERS][1].key if len(found) > _LEADERS else (0, 0)
        self.held = dict(found[:_LEADERS])
        self.indexed = {pair: h.cnt for pair, h in self.held.items()}
        self.index = PairIndex(self.state, list(self.held), self.first_id) if self.held else None

    def _root(self, pair: Pair) -> Pair:
        """The rarest indexed pair that every chunk with `pair` holds."""
        tokens = [t for token in pair for t in self.spelled.get(token, (token,))]
        inner = [p for p in zip(tokens, tokens[1:]) if p in self.indexed]
        return min(inner, key=self.indexed.__getitem__)

    def _roots(self, pairs: list[Pair]) -> list[Pair]:
        return sorted({self._root(p) for p in pairs})

    def run(self, batched: bool) -> tuple[list[tuple[int, int, int]], int]:
        """The next pairs to merge (left, right, cnt), none if they may not be held; and chunks read."""
        read = 0
        while True:
            best = nsmallest(_RUN, self.held.items(), key=lambda x: x[1].key)
            least = -self.limit[0]
            sure = takewhile(lambda x: x[1].cnt > least or (x[1].exact and x[1].key < self.limit), best)
            run = independent_prefix([(*pair, h.cnt) for pair, h in sure])[: None if batched else 1]
            alike = Counter(h.cnt for h in self.held.values())
            tied = {cnt for _, _, cnt in run if alike[cnt] > 1 and cnt > least}
            unsure = [pair for pair, h in self.held.items() if h.cnt in tied and not h.exact]
            if not unsure:
                return run, read
            found, chunks = self.index.changes(self._roots(unsure), self.made, [], unsure, 0)
            read += chunks
            for pair in unsure:
                self.held[pair] = _Held(self.held[pair].cnt, found[pair].after)

    def merge(self, run: list[Pair]) -> int:
        """Merge the run and bring what is held up to date; returns the number of chunks read."""
        next_id = self.first_id + len(self.made)
        roots, least = self._roots(run), max(1, -self.limit[0])
        changes, read = self.index.changes(roots, self.made, run, list(self.held), least)
        for i, pair in enumerate(run):
            self.spelled[next_id + i] = tuple(t for token in pair for t in self.spelled.get(token, (token,)))
        self.made += run
        for pair, change in changes.items():
            old = self.held.pop(pair, None)
            new = _Held(change.cnt, change.after) if old is None else self._moved(old, change)
            if new.cnt:
                self.held[pair] = new
        for pair in run:
            self.held.pop(pair, None)
        if len(self.held) > 4 * _LEADERS:
            kept = nsmallest(2 * _LEADERS + 1, self.held.items(), key=lambda x: x[1].key)
            self.limit = min(self.limit, (kept[-1][1].key[0], -1))
            self.held = dict(kept[:-1])
        return read

    @staticmethod
    def _moved(old: _Held, change: Change) -> _Held:
        """Unless the first place was lost, it stays."""
        lost = change.before is not None and change.before <= old.first and change.after != old.first
        return _Held(old.cnt + change.cnt, old.first, old.exact and not lost)


def train(
    dictionary: DataFrame,
    vocab_size: int,
    name: str = "bpe",
    pattern: str | None = None,
    batched: bool = True,
) -> Training:
    """Train `vocab_size - 256` merges from a chunk dictionary.

    Most frequent pair first, ties to the pair seen first in corpus order.
    `batched=False` takes one merge per round, for comparison.
    """
    if vocab_size < FIRST_MERGE_ID:
        raise ValueError("vocab_size must be at least 256")
    wanted = vocab_size - FIRST_MERGE_ID
    made = {"pattern": pattern} if pattern else {}
    if wanted == 0:
        return Training(Tokenizer(name, **made), (), 0)
    state = training_state(dictionary)
    merges: list[Pair] = []
    counts: list[int] = []
    sizes, touched, epochs, epoch = [], [], 0, None
    while len(merges) < wanted:
        run, read = epoch.run(batched) if epoch else ([], 0)
        if not run:
            if epoch and not epoch.limit[0]:  # all pairs were held
                raise ValueError(f"no pairs left after {len(merges)} merges")
            if epoch and epoch.made:
                state = cut_lineage(advance(state, epoch.made, epoch.first_id), "bpe-state")
            epoch, epochs = _Epoch(state, FIRST_MERGE_ID + len(merges)), epochs + 1
            if not epoch.held:
                raise ValueError(f"no pairs left after {len(merges)} merges")
            continue
        run = run[: wanted - len(merges)]
        merges += [(left, right) for left, right, _ in run]
        counts += [cnt for _, _, cnt in run]
        if len(merges) < wanted:
            read += epoch.merge([(left, right) for left, right, _ in run])
        sizes.append(len(run))
        touched.append(read)
    return Training(Tokenizer(name, tuple(merges), **made), tuple(counts), len(sizes), tuple(sizes), tuple(touched), epochs)


def train_sizes(
    dictionary: DataFrame, vocab_sizes: list[int], pattern: str | None = None
) -> list[Tokenizer]:
    """Tokenizers of several sizes from one training at the largest size."""
    largest = train(dictionary, max(vocab_sizes), pattern=pattern).tokenizer
    return [largest.prefix(n, f"regex_vocab_{n}") for n in vocab_sizes]
