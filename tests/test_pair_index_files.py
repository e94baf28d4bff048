"""The pair index is written where its chunks are read."""

from pyspark.sql import functions as F

from mergeloom.operators.pair_index import PairIndex, pair_key


def test_a_chunks_rows_stay_in_one_file(spark):
    rows = [([97 + i % 3, 98, 99, 97 + i % 5], i + 1, i) for i in range(400)]
    state = spark.createDataFrame(rows, "tokens array<int>, cnt long, rank long").repartition(4, "rank")
    pairs = [(97, 98), (98, 99), (99, 97)]
    index = PairIndex(state, pairs, 256)
    stored = index.rows.select("pair", "rank", "cnt", "tokens", F.input_file_name().alias("f")).collect()
    expected = {(pair_key(p), r, c, tuple(t)) for t, c, r in rows for p in pairs if p in zip(t, t[1:])}
    assert len(stored) == len(expected) and {(x.pair, x.rank, x.cnt, tuple(x.tokens)) for x in stored} == expected
    files = {}
    for x in stored:
        files.setdefault(x.rank, set()).add(x.f)
    assert all(len(f) == 1 for f in files.values())
    assert {(x["pair"], x["rank"]) for x in index.chunks([(97, 98)]).collect()} == {(p, r) for p, r, _, _ in expected if p == pair_key((97, 98))}
