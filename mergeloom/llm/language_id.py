"""Language identification: multinomial naive Bayes over hashed character n-grams.

Text is lower-cased and every run of characters that aren't letters becomes one
space. Runs of one to three characters are hashed into `BUCKETS` columns. Training
counts every n-gram of every training text, each task into one matrix; Spark adds the
matrices up. The smoothed log-probability matrix (languages x buckets, a size fixed by
the number of languages) is broadcast and batches are scored with NumPy.

The score is the posterior of the predicted language, with evidence tempered by
the text's length (a hundred n-grams count in full, longer texts as the square root), so long
texts don't all end at 1.0.

Edge cases: null texts, and texts without a letter, are `und` with score 0. Ties go
to the first language in alphabetical order. Rows with null lang never train. With nothing
to train on, every text is `und`. Repeated rows train repeatedly and are scored alike.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .blocks import mix, plain, slices
from .common import fold, give_back, text_of

BUCKETS = 1 << 14
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
FULL_EVIDENCE = 100.0
#: Below this posterior `accepted` rejects a text.
LEAST_SCORE = 0.5
UNKNOWN = "und"
_AT_ONCE = 1 << 19
#: Bytes of text whose n-grams are held at once.
_SLICE = 1 << 18
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters and single spaces of all texts, each text's offset in them (every
    text starts and ends with a space), and its count of letters."""
    lowered = [" " + t.lower() + " " for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) for t in lowered])
    letter = _is_letter()[points]
    keep = letter.copy()
    starts = ends - [len(t) for t in lowered]
    keep[1:] |= letter[:-1]  # the first separator after a letter
    keep[starts] = True
    before = np.concatenate([[0], np.cumsum(keep)])
    found = np.concatenate([[0], np.cumsum(letter)])
    points = np.where(letter, points, 32)[keep]
    return points, np.append(before[starts], before[-1]), found[ends] - found[starts]


def buckets(points: np.ndarray, order: int) -> np.ndarray:
    """The bucket of the n-gram that starts at each place."""
    size = max(0, len(points) - order + 1)
    key = np.zeros(size, np.uint64)
    for j in range(order):
        key = (key << np.uint64(21)) | points[j : j + size]
    salted = key + np.array([order], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mix(salted) % np.uint64(BUCKETS)).astype(np.intp)


def _pieces(points: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of every n-gram, some at a time; none crosses a row."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    for order in ORDERS:
        for a in range(0, len(points) - order + 1, _AT_ONCE):
            b = buckets(points[a : a + _AT_ONCE + order - 1], order)
            row = owner[a : a + len(b)]
            whole = row == owner[a + order - 1 : a + order - 1 + len(b)]
            yield row[whole], b[whole]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), plain(batch.column(1))
        done = 0
        for part in slices(texts, _SLICE):
            here = langs[done : done + len(part)]
            done += len(part)
            names = sorted(set(here))
            code = np.array([names.index(x) for x in here])
            points, offsets, _ = characters(part.to_pylist())
            for row, bucket in _pieces(points, offsets):
                counts = np.bincount(code[row] * BUCKETS + bucket, minlength=len(names) * BUCKETS)
                for i, name in enumerate(names):
                    totals.setdefault(name, np.zeros(BUCKETS, np.int64))
                    totals[name] += counts[i * BUCKETS : (i + 1) * BUCKETS]
    for name, total in totals.items():
        bucket = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(bucket), pa.string()), pa.array(bucket, pa.int32()), pa.array(total[bucket], pa.int64())],
            ["lang", "bucket", "n"],
        )


@dataclass(frozen=True)
class Model:
    langs: list[str]
    weights: np.ndarray  # languages x buckets, log-probabilities
    prior: np.ndarray


def train(docs: DataFrame) -> Model:
    """Counts over all rows of `docs` that have a lang."""
    rows = docs.where(docs["lang"].isNotNull()).select(docs["lang"].cast("string").alias("lang"), text_of(docs).alias("text"))
    counted = rows.mapInArrow(_counted, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counted.toArrow()  # a row per language and bucket at most
    priors = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(set(found["lang"].to_pylist()))
    weights = np.full((len(langs), BUCKETS), SMOOTHING)
    if langs:
        row = np.searchsorted(langs, found["lang"].to_numpy().astype(str))
        weights[row, found["bucket"].to_numpy()] += found["n"].to_numpy()
    total = np.array([priors[x] for x in langs], float)
    return Model(langs, np.log(weights / weights.sum(1, keepdims=True)).astype(np.float32), np.log(total / max(1.0, total.sum())))


def score(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Index of the best language (-1: none) and its posterior."""
    points, offsets, letters = characters(texts)
    sums, grams = np.zeros((len(model.langs), len(texts))), np.zeros(len(texts))
    for row, bucket in _pieces(points, offsets):
        grams += np.bincount(row, minlength=len(texts))
        for i in range(len(model.langs)):
            sums[i] += np.bincount(row, model.weights[i][bucket], len(texts))
    tempered = sums / np.maximum(1.0, np.sqrt(grams / FULL_EVIDENCE)) + model.prior[:, None]
    best = tempered.argmax(0)
    share = np.exp(tempered - tempered.max(0))
    posterior = share.max(0) / share.sum(0)
    return np.where(letters > 0, best, -1), np.where(letters > 0, posterior, 0.0)


def predictor(docs: DataFrame, model: Model) -> Callable[[Column], Column]:
    """A function from a text column to struct (lang_pred, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for texts in batches:
            langs, scores = [], []
            for part in slices(plain(texts), _SLICE):
                if not model.langs:
                    best, value = np.full(len(part), -1), np.zeros(len(part))
                else:
                    best, value = score(model, part.to_pylist())
                langs += [UNKNOWN if b < 0 else model.langs[b] for b in best]
                scores.append(value)
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())], ["lang_pred", "score"]
            )
        give_back()

    return F.arrow_udf(predict, "struct<lang_pred:string,score:double>").asNondeterministic()  # evaluated once, not again in a filter


def identify(docs: DataFrame, held_out: Column | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row; rows where `held_out` is true don't train."""
    out = fold(docs["doc_id"], 4) == 2 if held_out is None else held_out
    predict = predictor(docs, train(docs.where(~out)))
    return docs.select(docs["doc_id"], out.alias("held_out"), predict(text_of(docs)).alias("p")).select(
        "doc_id", "held_out", "p.lang_pred", "p.score"
    )


def accepted(docs: DataFrame) -> DataFrame:
    """Rows whose text has a language: not `und`, and a posterior of LEAST_SCORE
    at least. All columns stay as they are."""
    predict = predictor(docs, train(docs.where(fold(docs["doc_id"], 4) != 2)))
    names = docs.columns
    mark = "_language"
    while mark in names:
        mark += "_"
    kept = docs.withColumn(mark, predict(text_of(docs))).where((F.col(f"`{mark}`.lang_pred") != UNKNOWN) & (F.col(f"`{mark}`.score") >= LEAST_SCORE))
    return kept.drop(mark)
