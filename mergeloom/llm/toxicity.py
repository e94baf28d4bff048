"""Toxicity by a factorization machine over hashed terms.

score = sigmoid(b + sum w_i + 1/2n * sum_f ((sum v_if)^2 - sum v_if^2)) over the n distinct fitted terms (hashed
words) of a text: single terms, and pairs of terms through their factors, such as
an insult with a mention of a group.

Fitting takes at most `FIT_ROWS` labelled documents (those with the smallest
hash of doc_id) and works on their hashed terms on the driver, which bounds it by FIT_ROWS
x distinct buckets. Every term of them gets a weight and factors. All decay; the linear weight of a term decays more,
the fewer standard errors its own share of toxic documents lies off the average, and its factors as all others,
so that terms which say something only together are learnt. The weights, of a fixed size
(2^18 x 5 floats), are broadcast; all rows and whole texts are scored with NumPy.

Edge cases: null or wordless texts score sigmoid(b). Several labels of a doc_id count
as toxic if one is; null labels don't count. Without labels of both kinds, every score is the
share of toxic ones (0 if there is none). Repeated rows score alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .blocks import WORD, plain, slices, words
from .common import fold, text_of

BUCKETS = 1 << 18
FACTORS = 4
FIT_ROWS = 20_000
EPOCHS = 8
BATCH = 256
RATE = 1.0
DECAY = 1e-4
#: Standard errors at which a linear weight decays by DECAY; MOST_DECAY bounds how much more it is below.
SURE_Z = 3.0
MOST_DECAY = 30.0


def terms(texts: pa.Array) -> Iterator[np.ndarray]:
    """The distinct buckets of each text's words, sorted."""
    for part in slices(plain(texts)):
        w = words(part, WORD)
        found = (w.hashes % np.uint64(BUCKETS)).astype(np.int32)
        for a, b in zip(w.rows[:-1], w.rows[1:]):
            yield np.unique(found[a:b])


@dataclass(frozen=True)
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray  # BUCKETS x FACTORS
    known: np.ndarray  # which buckets were fitted; n counts these

    def raw(self, rows: list[np.ndarray]) -> np.ndarray:
        rows = [r[self.known[r]] for r in rows]
        return np.array([self.bias + _margin(self.linear[r], self.factors[r]) for r in rows])


def _margin(w: np.ndarray, v: np.ndarray) -> float:
    if not len(w):
        return 0.0
    sums = v.sum(0, dtype=np.float64)
    return float(w.sum(dtype=np.float64) + 0.5 * (sums @ sums - np.square(v).sum(dtype=np.float64)) / len(w))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit(rows: list[np.ndarray], toxic: np.ndarray, seed: int = 11) -> Machine:
    """Adaptive gradient steps on logistic loss."""
    share = float(toxic.mean()) if len(toxic) else 0.0
    linear, factors = np.zeros(BUCKETS, np.float32), np.zeros((BUCKETS, FACTORS), np.float32)
    if share in (0.0, 1.0):
        return Machine(40.0 if share else -40.0, linear, factors, np.zeros(BUCKETS, bool))
    bias = float(np.log(share / (1 - share)))
    length = np.array([len(r) for r in rows])
    start = np.cumsum(length) - length
    seen, flat = np.unique(np.concatenate(rows), return_inverse=True)
    flat, size = flat.astype(np.int32), len(seen)
    n, k = np.bincount(flat, minlength=size), np.bincount(flat, np.repeat(toxic, length), size)
    z = np.abs(k - n * share) / np.sqrt(n * share * (1 - share))
    decay = (DECAY * np.minimum((SURE_Z / np.maximum(z, 1e-3)) ** 4, MOST_DECAY)).astype(np.float32)
    rng = np.random.default_rng(seed)
    w, v = np.zeros(size, np.float32), rng.normal(0, 0.05, (size, FACTORS)).astype(np.float32)
    power_w, power_v = np.full(size, 1e-3, np.float32), np.full((size, FACTORS), 1e-2, np.float32)
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for a in range(0, len(order), BATCH):
            chosen = order[a : a + BATCH]
            chosen = chosen[length[chosen] > 0]
            if not len(chosen):
                continue
            many = length[chosen]
            first = np.cumsum(many) - many
            place = flat[np.repeat(start[chosen] - first, many) + np.arange(many.sum())]
            here = v[place]
            sums = np.add.reduceat(here, first)
            squares = np.add.reduceat(np.square(here).sum(1), first)
            margin = bias + np.add.reduceat(w[place], first) + 0.5 * (np.square(sums).sum(1) - squares) / many
            error = (sigmoid(margin) - toxic[chosen]) / len(chosen)
            bias -= RATE * float(error.sum())
            step = np.bincount(place, np.repeat(error, many), size) + decay * w
            power_w += step * step
            w -= (RATE * step / np.sqrt(power_w)).astype(np.float32)
            own = np.bincount(place, np.repeat(error / many, many), size)
            for f in range(FACTORS):
                step = np.bincount(place, np.repeat(error / many * sums[:, f], many), size) + (DECAY - own) * v[:, f]
                power_v[:, f] += step * step
                v[:, f] -= (RATE * step / np.sqrt(power_v[:, f])).astype(np.float32)
    known = np.zeros(BUCKETS, bool)
    linear[seen], factors[seen], known[seen] = w, v, True
    return Machine(bias, linear, factors, known)


def _terms_column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        found = list(terms(texts))
        offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32))
        yield pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(found) if found else np.zeros(0, np.int32)))


def train(docs: DataFrame, labels: DataFrame) -> Machine:
    """Fit on at most FIT_ROWS of the labelled documents."""
    marks = labels.where(labels["toxic"].isNotNull() & labels["doc_id"].isNotNull())
    marks = marks.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS)
    text = docs.select(docs["doc_id"], text_of(docs).alias("text")).join(F.broadcast(chosen), "doc_id")
    found = text.select("doc_id", "toxic", F.arrow_udf(_terms_column, "array<int>")("text").alias("terms")).toArrow()
    found = found.sort_by([("doc_id", "ascending")]).slice(0, FIT_ROWS)  # ids may repeat in docs
    toxic = found["toxic"].to_numpy().astype(np.float64)
    return fit([np.asarray(r.values) for r in found["terms"]], toxic)


def scorer(docs: DataFrame, machine: Machine):
    """A function from a text column to the score."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(sigmoid(shared.value.raw(list(terms(texts)))), pa.float64())

    return F.arrow_udf(score, "double").asNondeterministic()  # evaluated once


def decide(docs: DataFrame, labels: DataFrame, held_out: Column | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted for every row. Labels of ids in the fold
    (crc32 of the id modulo 5 = 0) don't train."""
    machine = train(docs, labels.where(fold(labels["doc_id"], 5) != 0))
    out = fold(docs["doc_id"], 5) == 0 if held_out is None else held_out
    rows = docs.select(docs["doc_id"], out.alias("held_out"), scorer(docs, machine)(text_of(docs)).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
