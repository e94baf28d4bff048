import itertools
import zlib
from collections import defaultdict

import numpy as np

from mergeloom.llm import packing, token_output
from mergeloom.llm.encoding import Encoder, tokenizer_path

import cases

ODD = ["a  b", " x", " \n y", "tab\t x", "end ", "", "\x00 a b", "it's  two", "日本 語 x", "a. B\n\nc", "x 　 y", " 123 456", "é a", "a \x85b", "\x1cb \x1c", "<|endoftext|> x"]


def reference(text):
    """Ids by `tokenizers`, whole texts."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_those_of_tokenizers(spark, sf):
    encoder = Encoder.cached(tokenizer_path())
    texts = ODD + [r[1] or "" for r in cases.rows()] + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    for t in texts:
        assert encoder.encode(t).tolist() == reference(t), t[:50]


def test_word_store_is_bounded(monkeypatch):
    from mergeloom.llm import encoding

    monkeypatch.setattr(encoding, "KEPT_WORDS", 100)
    words = encoding._Words(lambda w: [ord(c) for c in w])
    for i in range(5000):
        assert words[f" w{i}"] == np.array([ord(c) for c in f" w{i}"], np.int32).tobytes()
    assert len(words["long" * 1000]) == 16_000 and 0 < len(words) <= 100 and "long" * 1000 not in words


def test_packing(spark):
    docs = cases.frame(spark)
    pieces = packing.pack(docs).collect()
    by_doc = defaultdict(list)
    for p in pieces:
        assert p.ids_crc32 == zlib.crc32(p.ids) and len(p.ids) == 4 * p.length
        by_doc[p.doc_id].append(p)
    texts = defaultdict(list)
    for r in cases.rows():
        texts[r[0]].append(r[1])
    assert set(by_doc) == set(texts)
    for doc, group in by_doc.items():
        want = [reference(t) + [1] for t in texts[doc]]
        assert all(p.doc_tokens in {len(w) for w in want} for p in group)
        assert sum(p.length for p in group) == sum(map(len, want))
        if len(want) == 1:
            group.sort(key=lambda p: p.start)
            assert [p.start for p in group] == [0, *np.cumsum([p.length for p in group])[:-1]]
            assert np.concatenate([np.frombuffer(p.ids, "<u4") for p in group]).tolist() == want[0]
    by_sequence = defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append(p)
    for group in by_sequence.values():
        group.sort(key=lambda p: p.offset)
        assert [p.offset for p in group] == [0, *np.cumsum([p.length for p in group])[:-1]]
        assert sum(p.length for p in group) <= packing.SEQUENCE
    order = [p.doc_id for s in sorted(by_sequence) for p in by_sequence[s]]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))  # document order
    assert packing.pack(cases.empty(spark)).count() == 0


def best_cost(places, costs, limit):
    """Least cost over all sets of cuts, by trying them."""
    last, best = places[-1], float("inf")
    inner = list(zip(places, costs))[:-1]
    for n in range(len(inner) + 1):
        for chosen in itertools.combinations(inner, n):
            ends = [0, *(p for p, _ in chosen), last]
            if all(b - a <= limit for a, b in zip(ends, ends[1:])):
                cost = sum(limit - (b - a) for a, b in zip(ends, ends[1:])) + sum(c for _, c in chosen) + costs[-1]
                best = min(best, cost)
    return best


def test_cuts_are_optimal():
    rng = np.random.default_rng(2)
    for _ in range(40):
        places = sorted({int(x) for x in rng.integers(1, 60, 9)} | {10, 20, 30, 40, 50, 60})
        costs = [int(x) for x in rng.integers(0, 9, len(places))]
        cuts = packing.best_cuts(places, costs, 16)
        ends = [0, *cuts]
        assert cuts[-1] == places[-1] and all(b - a <= 16 for a, b in zip(ends, ends[1:]))
        price = dict(zip(places, costs))
        got = sum(16 - (b - a) for a, b in zip(ends, ends[1:])) + sum(price[c] for c in cuts)
        assert got == best_cost(places, costs, 16)


def test_little_padding(spark, sf):
    pieces = packing.pack(spark.read.parquet(f"{sf}/documents.parquet").coalesce(1))
    tokens, sequences = pieces.selectExpr("sum(length)", "count(distinct sequence_id)").first()
    # Every partition's last sequence may be short.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert tokens / (2048 * (sequences - parts)) > 0.98


def test_permutation():
    for size in (1, 2, 3, 10, 1000, 4097):
        for key in (1, 2):
            assert sorted(token_output.permuted(np.arange(size), size, key).tolist()) == list(range(size))
    assert token_output.permuted(np.arange(1000), 1000, 1).tolist() != token_output.permuted(np.arange(1000), 1000, 2).tolist()


def test_shards_round_trip(spark, monkeypatch):
    monkeypatch.setattr(token_output, "SHARD_SLOTS", 16)
    docs = cases.frame(spark).coalesce(1)
    shards = token_output.write_shards(docs, 5)
    rows = shards.records().orderBy("position").collect()
    assert [r.position for r in rows] == list(range(len(rows))) and len({r.shard for r in rows}) > 1
    stream = [t for r in docs.select("text").collect() for t in reference(r.text) + [1]]
    want = np.array(stream + [1] * (-len(stream) % token_output.SEQUENCE), "<u2").reshape(-1, token_output.SEQUENCE)
    assert sorted(bytes(r.ids) for r in rows) == sorted(w.tobytes() for w in want)
    assert [bytes(r.ids) for r in rows] != [w.tobytes() for w in want]  # another order
    again = token_output.write_shards(docs, 5).records().orderBy("position").collect()
    assert [bytes(r.ids) for r in again] == [bytes(r.ids) for r in rows]
    part = shards.read_range(3, 9).collect()
    assert [(r.position, bytes(r.ids)) for r in part] == [(r.position, bytes(r.ids)) for r in rows[3:9]]
    assert token_output.write_shards(cases.empty(spark), 5).records().count() == 0
