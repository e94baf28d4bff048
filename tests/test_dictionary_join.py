"""The dictionary join moves and stores a chunk once a block of documents, not once an occurrence."""

import os
import random

import pytest
from pyspark.sql import functions as F

from mergeloom.operators import codec, dictionary
from mergeloom.operators.tokenizer import Tokenizer
from mergeloom.plans import catalog
from mergeloom.session import freed_shuffles, scratch
from mergeloom.sources import corpus

PLAIN = Tokenizer("plain", ())
MERGED = Tokenizer("merged", ((32, 119), (48, 49), (256, 48), (256, 257)))


def _texts(n, words, seed=5):
    draw = random.Random(seed)
    return [" ".join(f"w{draw.randrange(40):02d}é" for _ in range(words)) for _ in range(n)]


def _docs(spark, rows, parts=3):
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)


def _rows(df):
    return sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["tokens"]) for r in df.collect())


def test_occurrences_are_not_stored_row_by_row(spark):
    docs = _docs(spark, list(enumerate(_texts(30, 400))))
    with scratch(spark) as folder:
        got = codec.encode_by_dictionary(docs, MERGED).collect()
        stored = sum(spark.read.parquet(f"{folder}/{name}").count() for name in os.listdir(folder))
    occurrences = docs.select(F.size(codec.chunk_column(F.col("text"), MERGED, "none")).alias("n")).agg(F.sum("n")).first()[0]
    assert len(got) == 30 and occurrences > 20_000 and stored < occurrences / 10


@pytest.mark.parametrize("limit", [1, 700])
def test_many_blocks_and_packs(spark, monkeypatch, limit):
    for name in ("_BLOCK_BYTES", "_PACK_ROWS", "_DEAL_BYTES"):
        monkeypatch.setattr(codec, name, limit)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        rows = [*enumerate(_texts(25, 30)), (100, None), (101, ""), (102, " \n"), (103, "漢字" * 300)]
        docs = _docs(spark, rows)
        got = _rows(codec.encode_by_dictionary(docs, MERGED))
        narrow = codec.encode_documents(docs, MERGED).select("doc_id", F.coalesce("tokens", F.array().cast("array<int>")).alias("tokens"))
        assert got == _rows(narrow)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_rows_of_one_id_share_their_tokens(spark):
    docs = _docs(spark, [(1, "c d e"), (1, "a b"), (2, "x"), (None, "y"), (None, "z"), (3, None), (3, "q"), (3, "p")])
    both = [97, 99, 32, 98, 32, 100, 32, 101]
    want = [(False, 0, []), (False, 0, []), (True, 1, both), (True, 1, both), (True, 2, [120])] + [(True, 3, [112, 113])] * 3
    assert _rows(codec.encode_by_dictionary(docs, PLAIN)) == want


def test_nothing_to_encode(spark):
    assert codec.encode_by_dictionary(_docs(spark, []), MERGED).collect() == []
    assert _rows(codec.encode_by_dictionary(_docs(spark, [(7, None)]), MERGED)) == [(True, 7, [])]


def test_training_leaves_no_tables(spark, tmp_path):
    _docs(spark, list(enumerate(_texts(40, 60) + ["the quick brown fox jumps over lazy dogs 1234567890 " * 3]))).write.parquet(f"{tmp_path}/documents.parquet")
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    with scratch(spark) as folder:
        assert len(catalog.training(spark, str(tmp_path)).tokenizer.merges) == catalog.MERGES
        assert not os.path.exists(folder) or os.listdir(folder) == []
        with freed_shuffles(spark):
            assert spark.conf.get(key) == "true"
    assert spark.conf.get(key, None) == before


@pytest.mark.parametrize("first", [0, -(1 << 31) + 1, (1 << 31) - 2, 1 << 31, -(1 << 62)])
def test_places_of_any_id(spark, first):
    texts = ["  a b\n", " \n ", "b\n\n c", None, "a\tb ", ""]
    docs = _docs(spark, [(first + i, t) for i, t in enumerate(texts)])
    key = lambda r: (r["chunk"], r["cnt"], r["first_doc"], r["first_idx"])
    got = sorted(map(key, corpus.joined_dictionary(docs).collect()))
    assert got == sorted(map(key, dictionary.chunk_dictionary(corpus.with_separators(docs.filter("text is not null"))).collect()))
