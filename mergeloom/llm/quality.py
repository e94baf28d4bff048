"""Quality by a generalised additive model with pairwise interactions.

score = sigmoid(bias + sum_f T_f[bin of x_f] + sum_(f,g) T_fg[bin of x_f, bin of x_g]) over the
features of a whole text listed in `FEATURES`. The tables are learnt by cyclic boosting: round after
round, each feature in turn gets one shallow tree (two levels of cuts on that feature alone) fitted to
the gradient of the logistic loss, shrunk by RATE and added to its table. Then the pairs whose joint
cuts would lower the loss most are chosen, and boosted in the same way with trees that cut first one,
then the other feature. Scoring is a bin search and a table addition for a whole batch at a time.

Fitting takes at most `FIT_ROWS` labelled documents (those with the smallest hash of doc_id). Their
features, a fixed number of floats each, are computed in tasks and reduced to one row per doc_id
before they reach the driver; texts never do. Bin edges are quantiles of the same sample. All rows and whole texts
are scored.

Edge cases: null text counts as empty; an empty text has features of 0 and is scored like others. A
very long text is worked on whole, in a slice of its own. Several labels of a doc_id count as good if
one is; null labels and labels of null ids don't count. Of texts that share a doc_id, the least
feature row teaches. Without labels of both kinds, every score is the share of good ones (0 if there is none).
Repeated rows score alike. Ties between cuts go to the first. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .blocks import NOT_SPACE, flat, plain, slices, words
from .common import fold, text_of

FEATURES = (
    "log_bytes", "letters", "capitals", "digits", "stops", "shouts", "symbols", "foreign", "breaks",
    "word_bytes", "long_words", "short_words", "symbol_words", "capital_words", "bare_words",
    "distinct_words", "top_word", "distinct_runs", "echoes", "longest_echo", "line_words", "distinct_lines",
)
FIT_ROWS = 20_000
BINS = 32
PAIR_BINS = 12
PAIRS = 10
ROUNDS = 150
PAIR_ROUNDS = 60
RATE = 0.15
#: Least curvature (about a quarter of a row each) on both sides of a cut, and what is added to it in a leaf.
LEAST_CURVATURE = 2.0
RIDGE = 1.0
#: Words to a run whose repetition is measured.
RUN = 8

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _class(characters: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters.encode())] = True
    return out


_CLASSES = {
    "letters": _LETTER,
    "capitals": _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "digits": _class("0123456789"),
    "stops": _class(".,;:"),
    "shouts": _class("!?"),
    "symbols": _class("#$%&*+/<=>@[\\]^_`{|}~"),
    "foreign": ~_class(bytes(range(128)).decode()),
    "breaks": _class("\n"),
}


def _repeats(values: np.ndarray) -> tuple[float, float]:
    """Share of distinct values, and of the most frequent one."""
    if not len(values):
        return 0.0, 0.0
    counts = np.unique(values, return_counts=True)[1]
    return len(counts) / len(values), counts.max() / len(values)


def features(texts: pa.Array) -> np.ndarray:
    """A row of FEATURES for every text; null counts as empty."""
    rows = [_features(part) for part in slices(plain(texts))]
    return np.concatenate(rows) if rows else np.zeros((0, len(FEATURES)))


def _features(part: pa.Array) -> np.ndarray:
    data, offsets = flat(part)
    size = np.diff(offsets)
    out = {"log_bytes": np.log1p(size)}
    for name, kind in _CLASSES.items():
        total = np.concatenate([[0], np.cumsum(kind[data])])
        out[name] = (total[offsets[1:]] - total[offsets[:-1]]) / np.maximum(size, 1)
    w = words(part, NOT_SPACE)
    many = np.maximum(np.diff(w.rows), 1)

    def share(mark: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(mark)])
        return (total[w.rows[1:]] - total[w.rows[:-1]]) / many

    length = w.ends - w.starts
    last, first = data[w.ends - 1], data[w.starts]
    seen = np.concatenate([[0], np.cumsum(_LETTER[data])])
    out["word_bytes"] = share(length)
    out["long_words"] = share(length > 15)
    out["short_words"] = share(length < 3)
    out["symbol_words"] = share(_CLASSES["symbols"][last] | _CLASSES["shouts"][last])
    out["capital_words"] = share(_CLASSES["capitals"][first])
    out["bare_words"] = share(seen[w.ends] == seen[w.starts])  # without a letter
    for name in ("distinct_words", "top_word", "distinct_runs", "echoes", "longest_echo", "distinct_lines"):
        out[name] = np.zeros(len(part))
    line = np.searchsorted(np.flatnonzero(data == 10), w.starts)
    for i, (a, b) in enumerate(zip(w.rows[:-1], w.rows[1:])):
        hashes = w.hashes[a:b]
        out["distinct_words"][i], out["top_word"][i] = _repeats(hashes)
        whole = len(hashes) // RUN * RUN
        sums = np.cumsum(np.concatenate([np.zeros(1, np.uint64), hashes * np.uint64(0x9E3779B97F4A7C15)]))
        out["distinct_runs"][i] = _repeats(sums[RUN:] - sums[:-RUN])[0] if whole else 1.0 * (len(hashes) > 0)
        if len(hashes):
            changes = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1], [True]]))
            out["echoes"][i] = 1 - (len(changes) - 1) / len(hashes)
            out["longest_echo"][i] = np.log(np.diff(changes).max())
            starts = np.flatnonzero(np.concatenate([[True], np.diff(line[a:b]) > 0]))
            out["distinct_lines"][i] = _repeats(np.add.reduceat(hashes, starts))[0]
    out["line_words"] = np.log1p(np.diff(w.rows) / (1 + out["breaks"] * size))
    return np.column_stack([out[name] for name in FEATURES])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


@dataclass(frozen=True)
class Model:
    bias: float
    edges: list[np.ndarray]  # of each feature's bins
    tables: np.ndarray  # feature x BINS
    coarse: np.ndarray  # feature x BINS: the pair bin of a bin
    pairs: list[tuple[int, int]]
    joint: np.ndarray  # pair x PAIR_BINS x PAIR_BINS

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, f], "right") for f, e in enumerate(self.edges)])

    def raw(self, x: np.ndarray) -> np.ndarray:
        found = self.bins(x)
        out = np.full(len(x), self.bias)
        for f in range(found.shape[1]):
            out += self.tables[f][found[:, f]]
        for (f, g), table in zip(self.pairs, self.joint):
            out += table[self.coarse[f][found[:, f]], self.coarse[g][found[:, g]]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.raw(x))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """(gain, first bin on the right) of the cut that lowers the loss most; (0, 0) without one."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    won = _gain(left_g, left_h) + _gain(right_g, right_h) - _gain(g.sum(), h.sum())
    won = np.where((left_h >= LEAST_CURVATURE) & (right_h >= LEAST_CURVATURE), won, 0.0)
    at = int(won.argmax()) if len(won) else 0
    return (float(won[at]), at + 1) if len(won) and won[at] > 0 else (0.0, 0)


def tree(g: np.ndarray, h: np.ndarray, levels: int = 2) -> np.ndarray:
    """Leaf values by bin of a tree with `levels` levels of cuts."""
    gain, at = best_cut(g, h) if levels else (0.0, 0)
    if gain <= 0:
        return np.full(len(g), -g.sum() / (h.sum() + RIDGE))
    return np.concatenate([tree(g[:at], h[:at], levels - 1), tree(g[at:], h[at:], levels - 1)])


def pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, leaf values by cell) of the best tree that cuts rows first and then each side's columns."""
    down_g, down_h = np.cumsum(g, 0), np.cumsum(h, 0)
    best, chosen = 0.0, None
    for at in range(1, len(g)):
        sides = [(down_g[at - 1], down_h[at - 1]), (down_g[-1] - down_g[at - 1], down_h[-1] - down_h[at - 1])]
        if min(side[1].sum() for side in sides) < LEAST_CURVATURE:
            continue
        gain = sum(best_cut(*side)[0] + _gain(side[0].sum(), side[1].sum()) for side in sides)
        gain -= _gain(g.sum(), h.sum())
        if gain > best + 1e-12:
            best, chosen = gain, (at, [tree(*side, levels=1) for side in sides])
    if chosen is None:
        return 0.0, np.zeros_like(g)
    at, (upper, lower) = chosen
    return best, np.concatenate([np.tile(upper, (at, 1)), np.tile(lower, (len(g) - at, 1))])


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """At most bins - 1 ascending edges at quantiles of the values."""
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def fit(x: np.ndarray, good: np.ndarray) -> Model:
    """Cyclic boosting of the single features, then of the chosen pairs."""
    count = len(FEATURES) if not len(x) else x.shape[1]
    share = float(good.mean()) if len(good) else 0.0
    edges = [_edges(x[:, f], BINS) if len(x) else np.zeros(0) for f in range(count)]
    tables, coarse = np.zeros((count, BINS)), np.zeros((count, BINS), np.int64)
    if share in (0.0, 1.0):
        return Model(40.0 if share else -40.0, edges, tables, coarse, [], np.zeros((0, PAIR_BINS, PAIR_BINS)))
    bias = float(np.log(share / (1 - share)))
    found = Model(bias, edges, tables, coarse, [], np.zeros((0, 0, 0))).bins(x)
    raw = np.full(len(x), bias)

    def sums(cell: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        p = sigmoid(raw)
        return np.bincount(cell, p - good, size), np.bincount(cell, p * (1 - p), size)

    for _ in range(ROUNDS):
        for f in range(count):
            step = RATE * tree(*sums(found[:, f], BINS))
            tables[f] += step
            raw += step[found[:, f]]

    for f in range(count):  # neighbouring bins joined to pair bins of about equal weight
        weight = np.cumsum(np.bincount(found[:, f], minlength=BINS))
        coarse[f] = np.minimum((weight - 1) * PAIR_BINS // max(1, len(x)), PAIR_BINS - 1)
    small = np.column_stack([coarse[f][found[:, f]] for f in range(count)])
    cells = {(f, g): small[:, f] * PAIR_BINS + small[:, g] for f, g in combinations(range(count), 2)}

    def fitted(cell: np.ndarray) -> tuple[float, np.ndarray]:
        g, h = (s.reshape(PAIR_BINS, PAIR_BINS) for s in sums(cell, PAIR_BINS**2))
        (one, down), (two, across) = pair_tree(g, h), pair_tree(g.T, h.T)
        return (one, down) if one >= two else (two, across.T)

    gains = {pair: fitted(cell)[0] for pair, cell in cells.items()}
    pairs = sorted((p for p in gains if gains[p] > 0), key=lambda p: -gains[p])[:PAIRS]
    joint = np.zeros((len(pairs), PAIR_BINS, PAIR_BINS))
    for _ in range(PAIR_ROUNDS):
        for i, pair in enumerate(pairs):
            step = RATE * fitted(cells[pair])[1]
            joint[i] += step
            raw += step.ravel()[cells[pair]]
    return Model(bias, edges, tables, coarse, pairs, joint)


def _features_column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        found = features(texts)
        offsets = np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]
        yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel()))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on at most FIT_ROWS of the labelled documents."""
    marks = labels.where(labels["quality"].isNotNull() & labels["doc_id"].isNotNull())
    marks = marks.groupBy("doc_id").agg(F.max("quality").cast("int").alias("good"))
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS)  # bounded, so it may be broadcast
    text = docs.select(docs["doc_id"], text_of(docs).alias("text")).join(F.broadcast(chosen), "doc_id")
    found = text.select("doc_id", "good", F.arrow_udf(_features_column, "array<double>")("text").alias("x"))
    rows = found.groupBy("doc_id", "good").agg(F.min("x").alias("x")).toArrow().sort_by("doc_id")  # ids may repeat in docs
    x = rows["x"].combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
    return fit(x, rows["good"].to_numpy().astype(np.float64))


def scorer(docs: DataFrame, model: Model):
    """A function from a text column to the score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(shared.value.score(features(texts)), pa.float64())

    return F.arrow_udf(score, "double").asNondeterministic()  # evaluated once


def decide(docs: DataFrame, labels: DataFrame, least: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; predicted is 1 from a score of `least` on.
    Labels of ids in the fold (crc32 of the id modulo 5 = 0) don't train."""
    model = train(docs, labels.where(fold(labels["doc_id"], 5) != 0))
    rows = docs.select(
        docs["doc_id"], (fold(docs["doc_id"], 5) == 0).alias("held_out"), scorer(docs, model)(text_of(docs)).alias("score")
    )
    return rows.withColumn("predicted", (F.col("score") >= least).cast("int"))
