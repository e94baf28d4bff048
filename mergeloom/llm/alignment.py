"""Cross-tokenizer alignment of the tokens of two vocabularies on the same bytes.

Tokenizer A (byte-level BPE) encodes a space and the text, tokenizer B (sentence pieces, which adds
the space itself) the text. Both token lists are turned into lists of byte offsets at which tokens
end. The shorter end list drives a galloping search into the longer one: from where the rank in
proportion says, steps double until the offset is enclosed, then a binary search closes in. That gives, for
every driving token, the rank of its end in the other list. Equal ends cut the tokens into groups, and the difference of
two neighbouring ranks is the range of tokens that one token overlaps: its links. All texts of a
slice are searched at once.

Spark's part: every document's tokens are aligned once and its distinct linked id pairs are stored
with their counts. Pair counts are added up over all documents (combined on the map side), the highest of every B id is joined
to them, and each document looks its pairs up again. The pairs above a share of all links, at most HOT_PAIRS,
are broadcast; rarer ones meet in a shuffled join in which no key is frequent.

`align` returns tokens, groups and links (ids and byte ranges); `decide` the digest.

Edge cases: null and empty texts, and texts that a tokenizer changes (joined token bytes differ from space and
text), have no tokens: zeros and an empty digest. Very long texts are worked on whole, in a slice of their
own. Rows that repeat a doc_id, or have none, are documents of their own: each counts. Ties for the highest count all
count as best. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .blocks import plain, slices
from .common import cut_lineage, new_path, text_of
from .encoding import Encoder, tokenizer_path

#: A pair is hot if it has more than 1 / HOT_PAIRS of all links (or if there are no more pairs than that).
HOT_PAIRS = 1 << 19
_SPACE = "▁"
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>").fullmatch
_pieces: dict[str, "Pieces"] = {}


class Pieces:
    """A sentence-piece model and the bytes of its ids."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.spelled = [
            bytes([int(m[1], 16)]) if (m := _BYTE_PIECE(name)) else name.replace(_SPACE, " ").encode() for name in names
        ]

    @classmethod
    def cached(cls, path: str) -> "Pieces":
        """One per Python worker."""
        if path not in _pieces:
            _pieces[path] = cls(path)
        return _pieces[path]


def byte_spellings(encoder: Encoder) -> list[bytes]:
    """The bytes of every id of A, b"" for ids that no text gives."""
    out = [b""] * encoder.fast.n_vocab
    for token in encoder.fast.token_byte_values():
        out[encoder.fast.encode_single_token(token)] = token
    return out


def gallop(keys: np.ndarray, ends: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many of the ascending `ends` lie below each key, searched from the places `at` outwards.

    Every key is at most the last end.
    """
    low, high = np.zeros(len(keys), np.int64), np.full(len(keys), len(ends) - 1)
    for sign, going in ((1, np.flatnonzero(ends[at] < keys)), (-1, np.flatnonzero(ends[at] >= keys))):
        (low if sign > 0 else high)[going] = at[going] + (sign > 0)
        step = 1
        while len(going):
            probe = at[going] + sign * step
            inside = (probe >= 0) & (probe < len(ends))
            going, probe = going[inside], probe[inside]
            below = ends[probe] < keys[going]
            low[going[below]] = probe[below] + 1
            high[going[~below]] = probe[~below]
            going = going[below if sign > 0 else ~below]
            step *= 2
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) >> 1
        below = ends[middle] < keys[open_]
        low[open_[below]] = middle[below] + 1
        high[open_[~below]] = middle[~below]
        open_ = open_[low[open_] < high[open_]]
    return low


@dataclass
class Tokens:
    """Tokens of several texts, one after the other."""

    ids: np.ndarray
    ends: np.ndarray  # byte offset over all texts where each token ends
    rows: np.ndarray  # tokens of text i are rows[i]:rows[i + 1]


@dataclass
class Alignment:
    """Links between driving and other tokens, and the group of each token."""

    short: np.ndarray
    long: np.ndarray
    links: np.ndarray  # links of text i are links[i]:links[i + 1]
    short_groups: np.ndarray
    long_groups: np.ndarray
    groups: np.ndarray  # groups of each text


def alignment(short: Tokens, long: Tokens) -> Alignment:
    """Align two tokenisations of the same bytes, texts that aren't empty; `short` drives the search."""
    many, others = np.diff(short.rows), np.diff(long.rows)
    text = np.repeat(np.arange(len(many)), many)
    place = np.arange(len(short.ids)) - short.rows[text]
    rank = gallop(short.ends, long.ends, long.rows[text] + place * others[text] // many[text])
    common = long.ends[rank] == short.ends
    first = np.concatenate([[0], (rank + common)[:-1]]).astype(np.int64)
    linked = rank - first + 1
    total = np.concatenate([[0], np.cumsum(linked)])
    ends_group = np.zeros(len(long.ids), np.int64)
    ends_group[rank[common]] = 1
    closed = np.concatenate([[0], np.cumsum(common)])
    return Alignment(
        np.repeat(np.arange(len(short.ids)), linked),
        np.arange(total[-1]) + np.repeat(first - total[:-1], linked),
        total[short.rows],
        closed[:-1],
        np.cumsum(ends_group) - ends_group,
        np.diff(closed[short.rows]),
    )


def _digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of 0..size-1, left-aligned with room for a separator, and how many they are."""
    width = len(str(size))
    names = np.arange(size).astype(f"S{width + 1}")
    return names.view(np.uint8).reshape(size, width + 1), np.char.str_len(names).astype(np.int64)


def group_texts(a: Tokens, b: Tokens, a_groups: np.ndarray, b_groups: np.ndarray, digits) -> list[bytes]:
    """Every text's groups, written as a1,a2|b1;a3|b2,b3."""
    spelled, widths = digits
    n = int(a_groups[-1]) + 1
    many_a, many_b = np.bincount(a_groups, minlength=n), np.bincount(b_groups, minlength=n)
    at_a = np.arange(len(a.ids)) + (np.cumsum(many_b) - many_b)[a_groups]
    at_b = np.arange(len(b.ids)) + np.cumsum(many_a)[b_groups]
    ids, after = np.empty(len(at_a) + len(at_b), np.int64), np.empty(len(at_a) + len(at_b), np.uint8)
    ids[at_a], ids[at_b] = a.ids, b.ids
    after[at_a] = np.where(np.diff(a_groups, append=n) > 0, ord("|"), ord(","))
    after[at_b] = np.where(np.diff(b_groups, append=n) > 0, ord(";"), ord(","))
    grid, width = spelled[ids], widths[ids]
    grid[np.arange(len(ids)), width] = after
    written = grid[np.arange(grid.shape[1]) <= width[:, None]].tobytes()
    ends = np.concatenate([[0], np.cumsum(width + 1)])[a.rows + b.rows]
    return [written[x : y - 1] for x, y in zip(ends[:-1], ends[1:])]


def _tokens(found: list[np.ndarray], widths: np.ndarray) -> Tokens:
    ids = np.concatenate(found).astype(np.int64)
    return Tokens(ids, np.cumsum(widths[ids]), np.concatenate([[0], np.cumsum([len(f) for f in found])]))


class Aligner:
    """Tokenizes and aligns the texts of a slice."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = Encoder.cached(path_a), Pieces.cached(path_b)
        self.spelled = byte_spellings(self.a), self.b.spelled
        self.widths = [np.array([len(s) for s in spelled]) for spelled in self.spelled]
        self.size_b = len(self.b.spelled)
        self.digits = _digits(max(map(len, self.spelled)))

    def both(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of A and B; None where they don't spell space and text."""
        if not text:
            return None
        want = (" " + text).encode()
        found = self.a.encode(" " + text), np.array(self.b.model.encode(text), np.int32)
        for ids, spelled in zip(found, self.spelled):
            if b"".join(map(spelled.__getitem__, ids.tolist())) != want:
                return None
        return found

    def slice(self, texts: list[str]) -> Iterator[tuple[list[int], Tokens, Tokens, Alignment, bool]]:
        """(rows, A's tokens, B's tokens, alignment, B drives) of the texts with tokens, by which list is shorter."""
        found = [self.both(t) for t in texts]
        for b_drives in (False, True):
            rows = [i for i, f in enumerate(found) if f is not None and (len(f[1]) < len(f[0])) == b_drives]
            if rows:
                a, b = (_tokens([found[i][side] for i in rows], self.widths[side]) for side in (0, 1))
                yield rows, a, b, alignment(b, a) if b_drives else alignment(a, b), b_drives


_ALIGNED = (
    "doc_id bigint, row bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "groups_sha256 string, pairs array<struct<pair:int,n:int>>"
)


def _aligned(aligner: Aligner, texts: pa.Array) -> list[pa.Array]:
    """n_a, n_b, n_groups, n_links, groups_sha256, pairs of every text."""
    parts = []
    for part in slices(plain(texts)):
        numbers = np.zeros((len(part), 4), np.int64)
        shas, sets = [""] * len(part), [(np.zeros(0, np.int32),) * 2] * len(part)
        for rows, a, b, found, b_drives in aligner.slice(part.to_pylist()):
            at_a, at_b = (found.long, found.short) if b_drives else (found.short, found.long)
            groups = (found.long_groups, found.short_groups) if b_drives else (found.short_groups, found.long_groups)
            numbers[rows] = np.column_stack([np.diff(a.rows), np.diff(b.rows), found.groups, np.diff(found.links)])
            for i, written in zip(rows, group_texts(a, b, *groups, aligner.digits)):
                shas[i] = hashlib.sha256(written).hexdigest()
            pair = a.ids[at_a] * aligner.size_b + b.ids[at_b]
            for i, x, y in zip(rows, found.links[:-1], found.links[1:]):
                distinct, times = np.unique(pair[x:y], return_counts=True)
                sets[i] = distinct.astype(np.int32), times.astype(np.int32)
        parts.append((numbers, shas, sets))
    numbers = np.concatenate([p[0] for p in parts]) if parts else np.zeros((0, 4), np.int64)
    sets = [s for p in parts for s in p[2]]
    offsets = np.concatenate([[0], np.cumsum([len(s[0]) for s in sets])]).astype(np.int32)
    pairs = [np.concatenate([s[k] for s in sets]) if sets else np.zeros(0, np.int32) for k in (0, 1)]
    listed = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(p, pa.int32()) for p in pairs], ["pair", "n"]))
    return [*(pa.array(n) for n in numbers.T), pa.array([s for p in parts for s in p[1]], pa.string()), listed]


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """doc_id and, per link, a_index, b_index, a_id, b_id, group_index, the byte range that both
    tokens cover (start, end, of space and text); a row per link, none for texts without tokens."""
    path_a, path_b = path_a or tokenizer_path(), path_b or tokenizer_path("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        for batch in batches:
            ids = batch.column(0)
            first = 0
            for part in slices(plain(batch.column(1))):
                for rows, a, b, found, b_drives in aligner.slice(part.to_pylist()):
                    at_a, at_b = (found.long, found.short) if b_drives else (found.short, found.long)
                    many = np.diff(found.links)
                    text = np.repeat(np.arange(len(rows)), many)
                    base = np.concatenate([[0], a.ends[a.rows[1:] - 1]])[text]
                    group = found.short_groups[found.short]
                    opened = np.concatenate([[0], np.cumsum(found.groups)])[text]
                    begin_a, begin_b = (np.concatenate([[0], t.ends]) for t in (a, b))
                    start = np.maximum(begin_a[at_a], begin_b[at_b])
                    end = np.minimum(a.ends[at_a], b.ends[at_b])
                    columns = [at_a - a.rows[text], at_b - b.rows[text], a.ids[at_a], b.ids[at_b], group - opened, start - base, end - base]
                    owner = ids.take(pa.array(first + np.repeat(np.array(rows), many)))
                    yield pa.RecordBatch.from_arrays([owner, *(pa.array(c, pa.int64()) for c in columns)], names)
                first += len(part)

    names = ["doc_id", "a_index", "b_index", "a_id", "b_id", "group_index", "start", "end"]
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), text_of(docs).alias("text"))
    return rows.mapInArrow(run, ", ".join(f"{n} bigint" for n in names))


def _documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The stored rows of _ALIGNED; `row` names each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        for batch in batches:
            # A few rows at a time, so that the pairs of long documents don't pile up.
            for first in range(0, batch.num_rows, 256):
                few = batch.slice(first, 256)
                columns = [few.column("doc_id"), few.column("row"), *_aligned(aligner, few.column("text"))]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in re.split(r", (?![^<]*>)", _ALIGNED)])

    rows = docs.select(
        docs["doc_id"].cast("bigint").alias("doc_id"), F.monotonically_increasing_id().alias("row"), text_of(docs).alias("text")
    )
    path = new_path(docs.sparkSession, "aligned")
    rows.mapInArrow(run, _ALIGNED).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(_ALIGNED).parquet(path)


def pair_counts(documents: DataFrame, size_b: int) -> DataFrame:
    """(pair, count, best) of every linked id pair of the corpus, stored: best is 1
    where no pair of the same B id has a higher count."""
    counts = documents.select(F.explode("pairs").alias("p")).groupBy("p.pair").agg(F.sum("p.n").alias("count"))
    counts = cut_lineage(counts, "pair-counts")
    highest = counts.groupBy((F.col("pair") % size_b).alias("b")).agg(F.max("count").alias("most"))
    # A row per id of B: bounded by its vocabulary.
    marked = counts.withColumn("b", F.col("pair") % size_b).join(F.broadcast(highest), "b")
    return cut_lineage(marked.select("pair", "count", (F.col("count") == F.col("most")).cast("bigint").alias("best")), "pairs")


def decide(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row."""
    path_a, path_b = path_a or tokenizer_path(), path_b or tokenizer_path("piece_bpe_32k.model")
    sizes = Encoder.cached(path_a).fast.n_vocab, len(Pieces.cached(path_b).spelled)
    if sizes[0] * sizes[1] >= 1 << 31:
        raise ValueError("these vocabularies have more id pairs than an int can number")
    documents = _documents(docs, path_a, path_b)
    pairs = pair_counts(documents, sizes[1])
    total, distinct = pairs.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count(F.lit(1))).first()
    floor = total // HOT_PAIRS if distinct > HOT_PAIRS else 0
    hot, cold = pairs.where(F.col("count") > floor), pairs.where(F.col("count") <= floor)
    linked = documents.select("row", F.explode("pairs").alias("p")).select("row", "p.pair", "p.n")

    def added(rows: DataFrame) -> DataFrame:
        return rows.groupBy("row").agg(F.sum(F.col("n") * F.col("best")).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum"))

    sums = added(linked.join(F.broadcast(hot), "pair"))
    if floor:
        # No rarer pair has more than `floor` links, so this join has no hot key.
        rare = linked.join(F.broadcast(hot.select("pair")), "pair", "left_anti").join(cold, "pair")
        sums = sums.unionByName(added(rare)).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("bigint")
    return documents.drop("pairs").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
