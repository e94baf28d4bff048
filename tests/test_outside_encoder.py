"""Outside tokenizers get a bounded part of a batch at a time."""

from mergeloom.operators import codec


def test_texts_are_handed_over_some_bytes_at_a_time(spark):
    size = 600_000
    rows = [(0, "a" * size), (1, None), (2, "b" * size), (3, ""), (4, "é" * size)]
    docs = spark.createDataFrame(rows, "doc_id int, text string").coalesce(1)
    together = codec.external_encoder(encode_batch=lambda texts: [[sum(len(t.encode()) for t in texts)] * 2 for _ in texts])
    got = dict(docs.select("doc_id", together("text").alias("n")).collect())
    assert got == {0: [size] * 2, 1: None, 2: [size] * 2, 3: [size] * 2, 4: [2 * size] * 2}


def test_ids_and_nulls_come_back(spark):
    rows = [(0, "ab"), (1, None), (2, ""), (3, "é")]
    docs = spark.createDataFrame(rows, "doc_id int, text string").coalesce(1)
    encoder, decoder = codec.external_encoder(lambda s: s.encode()), codec.external_decoder(lambda ids: bytes(ids).decode())
    coded = docs.select("doc_id", encoder("text").alias("tokens"))
    assert dict(coded.collect()) == {0: [97, 98], 1: None, 2: [], 3: [195, 169]}
    assert dict(coded.select("doc_id", decoder("tokens")).collect()) == dict(rows)
