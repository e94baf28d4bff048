import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import model
from mergeloom.functions import ragged
from mergeloom.functions.ragged import MergeRanks, merge_rows, pair_totals
from mergeloom.operators import codec, dictionary
from mergeloom.operators.bpe_train import independent_prefix, train, train_sizes
from mergeloom.operators.tokenizer import Tokenizer
from mergeloom.sources.corpus import with_separators


def corpus(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def words(seed, n_docs, alphabet="abc", longest=12):
    rng = random.Random(seed)
    return [
        " ".join("".join(rng.choice(alphabet) for _ in range(rng.randrange(1, longest))) for _ in range(25))
        for _ in range(n_docs)
    ]


@pytest.mark.parametrize("seed,alphabet", [(1, "ab"), (2, "abc"), (3, "aé漢")])
def test_training_equals_model(spark, seed, alphabet):
    texts = words(seed, 12, alphabet)
    merges, counts = model.train("\n\n".join(texts), 40)
    got = train(dictionary.chunk_dictionary(with_separators(corpus(spark, texts))), 296)
    assert list(got.tokenizer.merges) == merges
    assert list(got.counts) == counts
    assert got.rounds < 40


def test_one_at_a_time_training_agrees(spark):
    texts = words(9, 8, "abcd")
    d = dictionary.chunk_dictionary(with_separators(corpus(spark, texts)))
    assert train(d, 276, batched=False).tokenizer.merges == train(d, 276).tokenizer.merges


def test_tiny_words_ties_and_overlap(spark):
    texts = ["aaa", "abab", "aaaaaaaa"]
    merges, _ = model.train("\n\n".join(texts), 6)
    got = train(dictionary.chunk_dictionary(with_separators(corpus(spark, texts))), 262)
    assert list(got.tokenizer.merges) == merges


@pytest.mark.parametrize("leaders", [1, 3, 12])
def test_counting_anew_does_not_change_the_result(spark, monkeypatch, leaders):
    """With few pairs held, training counts and indexes many times; ties are common in such words."""
    import mergeloom.operators.bpe_train as module

    monkeypatch.setattr(module, "_LEADERS", leaders)
    texts = words(4, 6, "abcd", 9)
    merges, counts = model.train("\n\n".join(texts), 20)
    got = train(dictionary.chunk_dictionary(with_separators(corpus(spark, texts))), 276)
    assert (list(got.tokenizer.merges), list(got.counts)) == (merges, counts)
    assert got.epochs > 2 and sum(got.merged) == 20 and len(got.merged) == len(got.touched) == got.rounds


def test_rounds_read_only_chunks_of_their_pairs(spark, sf):
    """Chunks read per merge fall, and a round of one pair reads those that hold it."""
    d = dictionary.chunk_dictionary(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"))
    got = train(d, 256 + 100)
    chunks = [r["chunk"].encode() for r in d.collect()]
    per_merge = [t / m for t, m in zip(got.touched, got.merged)]
    assert got.epochs == 1 and sum(per_merge[-6:-1]) < sum(per_merge[:5]) / 2
    first = bytes(got.tokenizer.merges[0])
    assert got.merged[0] > 1 or got.touched[0] == sum(first in c for c in chunks)
    assert sum(got.touched) < len(chunks) * got.rounds / 3


def random_rows(rng, ids):
    rows = [[rng.randrange(ids) for _ in range(rng.randrange(2, 12))] for _ in range(30)]
    lengths = np.array([len(r) for r in rows], np.int64)
    return np.array([t for r in rows for t in r], np.int32), lengths


def test_changed_totals_are_the_difference_of_full_counts():
    rng = random.Random(6)
    for _ in range(200):
        values, lengths = random_rows(rng, 4)
        weights = np.array([rng.randrange(1, 9) for _ in lengths])
        ranks, widths = np.arange(len(lengths)), np.ones(10, np.int64)
        run = rng.sample([(a, b) for a in range(4) for b in range(4)], 2)
        widths[8:10] = 2
        keys = np.sort(np.array([a << 32 | b for a in range(4) for b in range(4)], np.int64))
        new = merge_rows(values, lengths, MergeRanks(run, 8))
        full = [dict(zip(t[0].tolist(), zip(*(x.tolist() for x in t[1:])))) for t in (pair_totals(values, lengths, weights, ranks), pair_totals(*new, weights, ranks, widths))]
        # In two batches, added up.
        half = len(lengths) // 2
        cut = [(v[: n[:half].sum()], n[:half], v[n[:half].sum() :], n[half:]) for v, n in ((values, lengths), new)]
        parts = [
            ragged.changed_totals(cut[0][2 * i : 2 * i + 2], cut[1][2 * i : 2 * i + 2], w, r, widths, keys, 8)
            for i, (w, r) in enumerate([(weights[:half], ranks[:half]), (weights[half:], ranks[half:])])
        ]
        told = {}
        for key, cnt, rank, index, after in zip(*(t.tolist() for t in ragged.combined_totals(parts))):
            told.setdefault(key, {})[after] = (cnt, rank, index)
        for key in full[0].keys() | full[1].keys():
            before, now = full[0].get(key, (0,)), full[1].get(key, (0,))
            change = told.get(key, {})
            assert now[0] - before[0] == sum(c[0] for c in change.values())
            if before[0] == 0:
                assert change[1][1:] == now[1:]


def test_training_errors(spark):
    d = dictionary.chunk_dictionary(corpus(spark, ["ab"]))
    with pytest.raises(ValueError):
        train(d, 255)
    with pytest.raises(ValueError):
        train(d, 258)  # only one pair to merge
    assert train(d, 256).tokenizer.merges == ()


def batched_model(rows, n):
    """Rounds of independent prefixes on plain lists."""
    merges = []
    while len(merges) < n:
        table = model.pair_table(rows)
        if not table:
            break
        first = {p: i for i, p in enumerate(table)}
        ranked = sorted(table, key=lambda p: (-table[p], first[p]))
        for left, right, _ in independent_prefix([(*p, table[p]) for p in ranked])[: n - len(merges)]:
            rows = [model.join_pair(r, (left, right), 256 + len(merges)) for r in rows]
            merges.append((left, right))
    return merges


def test_independent_prefix_is_exact_on_random_corpora():
    rng = random.Random(11)
    for _ in range(1500):
        symbols = rng.randrange(2, 7)
        rows = [[rng.randrange(symbols) for _ in range(rng.randrange(1, 14))] for _ in range(rng.randrange(1, 12))]
        merges, plain = [], [list(r) for r in rows]
        for k in range(12):
            table = model.pair_table(plain)
            if not table:
                break
            pair = max(table, key=table.get)
            merges.append(pair)
            plain = [model.join_pair(r, pair, 256 + k) for r in plain]
        assert batched_model(rows, len(merges)) == merges


def test_merge_rows_on_random_rows():
    rng = random.Random(5)
    for _ in range(300):
        merges, ids = [], list(range(4))
        while len(merges) < 8:
            pair = (rng.choice(ids), rng.choice(ids))
            if pair not in merges:
                ids.append(256 + len(merges))
                merges.append(pair)
        rows = [[rng.randrange(4) for _ in range(rng.randrange(0, 15))] for _ in range(6)]
        flat = np.array([t for r in rows for t in r], dtype=np.int32)
        lens = np.array([len(r) for r in rows], dtype=np.int64)
        values, out = merge_rows(flat, lens, MergeRanks(merges))
        got, at = [], 0
        for n in out:
            got.append(values[at : at + n].tolist())
            at += n
        rank = {p: k for k, p in enumerate(merges)}
        for row, result in zip(rows, got):
            while True:
                known = [rank[p] for p in zip(row, row[1:]) if p in rank]
                if not known:
                    break
                row = model.join_pair(row, merges[min(known)], 256 + min(known))
            assert row == result


def test_long_rows_equal_short_ones(monkeypatch):
    """Linked lists and passes give the same tokens, overlaps and empty rows included."""
    rng = random.Random(12)
    for _ in range(300):
        merges, ids = [], list(range(3))
        while len(merges) < 10:
            pair = (rng.choice(ids), rng.choice(ids))
            if pair not in merges:
                ids.append(256 + len(merges))
                merges.append(pair)
        rows = [[rng.randrange(3) for _ in range(rng.choice([0, 1, 2, 9, 40]))] for _ in range(5)]
        flat = np.array([t for r in rows for t in r], dtype=np.int32)
        lens = np.array([len(r) for r in rows], dtype=np.int64)
        monkeypatch.setattr(ragged, "LONG_ROW", 1 << 40)
        want = merge_rows(flat, lens, MergeRanks(merges))
        monkeypatch.setattr(ragged, "LONG_ROW", rng.choice([0, 2, 9]))
        got = merge_rows(flat, lens, MergeRanks(merges))
        assert got[0].tolist() == want[0].tolist() and got[1].tolist() == want[1].tolist()


def test_an_unbroken_chunk_of_10_megabytes():
    """512 merges on one chunk without a break, in seconds and without a pair left to merge."""
    rng = np.random.default_rng(3)
    base = rng.integers(97, 123, 4000).astype(np.uint8).tobytes().decode()
    merges, _ = model.train(base, 512)
    text = "".join(base[int(a) : int(a) + 2000] for a in rng.integers(0, 2000, 5000))
    flat = np.frombuffer(text.encode(), np.uint8)
    begin = time.perf_counter()
    values, lens = merge_rows(flat, np.array([len(flat)]), MergeRanks(merges))
    assert time.perf_counter() - begin < 60
    known = MergeRanks(merges).lookup(values[:-1], values[1:])
    assert (known == ragged._NONE).all() and lens.tolist() == [len(values)]
    vocab = Tokenizer("t", tuple(merges)).vocab
    assert b"".join(vocab[int(i)] for i in values) == text.encode()
    head = model.encode(text[:3000], merges)
    assert values[: len(head) - 10].tolist() == head[:-10]


def test_pair_totals_counts_overlaps():
    values, lens = np.array([7, 7, 7, 1, 7, 7], np.int32), np.array([3, 1, 2])
    # The longest ranks that a bigint holds: places are pairs, not one number.
    key, cnt, rank, index = pair_totals(values, lens, np.array([2, 5, 1]), np.array([(1 << 63) - 1, 0, 1]))
    assert (key.tolist(), cnt.tolist(), rank.tolist(), index.tolist()) == ([(7 << 32) | 7], [5], [1], [0])


def test_expression_pairs_agree_with_batches(spark):
    rows = spark.createDataFrame([("aaa", 2), ("ab", 1), ("x", 9)], "code string, cnt long")
    got = {r["pair"]: r["n"] for r in dictionary.exploded_pairs(rows).groupBy("pair").agg(F.sum("cnt").alias("n")).collect()}
    assert got == {"aa": 4, "ab": 1}


@pytest.fixture(scope="module")
def trained(spark):
    texts = words(21, 10, "abé ") + ["漢字漢字 aaab 12345"]
    return train(dictionary.chunk_dictionary(corpus(spark, texts)), 320).tokenizer


def test_encoders_agree_with_model(spark, trained):
    texts = model.ADVERSARIAL + words(22, 30, "abé 漢x")
    df = corpus(spark, texts)
    narrow = {r["doc_id"]: r["tokens"] for r in codec.encode_documents(df, trained).collect()}
    column = {r["doc_id"]: r["t"] for r in df.select("doc_id", codec.encode_column(trained).alias("t")).collect()}
    joined = {r["doc_id"]: r["tokens"] for r in codec.encode_by_dictionary(df, trained).collect()}
    for i, t in enumerate(texts):
        want = model.encode(t, trained.merges)
        assert narrow[i] == want and column[i] == want and joined[i] == want, repr(t)


def test_dictionary_join_with_a_hot_chunk(spark, trained):
    df = corpus(spark, ["ab " * 4000 + "x", "rare words here", ""])
    got = {r["doc_id"]: r["tokens"] for r in codec.encode_by_dictionary(df, trained).collect()}
    narrow = {r["doc_id"]: r["tokens"] for r in codec.encode_documents(df, trained).collect()}
    assert got == narrow


def test_decode_inverts_encode(spark, trained):
    texts = model.ADVERSARIAL + words(23, 20, "abé漢 ")
    bad = codec.roundtrip(corpus(spark, texts), trained).filter("not ok").count()
    assert bad == 0


def test_decode_of_cut_and_unknown_tokens(spark):
    tok = Tokenizer("t", ((97, 98),), specials={"<|end|>": 300})
    df = spark.createDataFrame([([256, 0xC3, 300, 0],)], "tokens array<int>")
    assert df.select(codec.decode_column(tok).alias("t")).first()["t"] == "ab�<|end|>\x00"
    unknown = spark.createDataFrame([([257],)], "tokens array<int>")
    with pytest.raises(Exception, match="invalid token id: 257"):
        unknown.select(codec.decode_column(tok)).collect()


def test_special_modes(spark, trained):
    tok = trained.with_specials({"<|a|>": 900, "<|b|>": 901})
    df = corpus(spark, ["x<|a|>yes<|b|>", "plain", "<|a|>"])
    def run(mode):
        return {r["doc_id"]: r["tokens"] for r in codec.encode_documents(df, tok, mode).collect()}
    def plain(t):
        return model.encode(t, tok.merges)
    assert run("all") == {0: plain("x") + [900] + plain("yes") + [901], 1: plain("plain"), 2: [900]}
    assert run({"<|b|>"})[0] == plain("x<|a|>yes") + [901]
    assert run("none")[2] == plain("<|a|>")
    column = df.select("doc_id", codec.encode_column(tok, "text", "all").alias("t"))
    assert {r["doc_id"]: r["t"] for r in column.collect()} == run("all")
    with pytest.raises(Exception, match="special token in text"):
        run("none_raise")
    with pytest.raises(Exception, match="special token in text"):
        codec.encode_documents(df, tok).collect()  # so by default
    with pytest.raises(Exception, match="special token in text"):
        df.select(codec.encode_column(tok)).collect()
    assert {r["doc_id"]: r["tokens"] for r in codec.token_documents(df, tok, 7).collect()}[2] == [7, *plain("<|a|>")]
    assert codec.encode_documents(df.filter("doc_id = 1"), tok, "none_raise").count() == 1
    with pytest.raises(ValueError):
        run("some")
    hits = {r["doc_id"]: r["token"] for r in codec.special_violations(df, list(tok.specials)).collect()}
    assert hits == {0: "<|a|>", 2: "<|a|>"}


def test_token_range_check(spark):
    df = spark.createDataFrame([([0, 65535],), ([65536],)], "tokens array<int>")
    assert sorted(r[0] for r in df.select(codec.out_of_range("tokens")).collect()) == [0, 1]
    with pytest.raises(Exception, match="16 bits"):
        df.select(codec.checked_tokens(F.col("tokens"))).collect()


def test_sizes_are_prefixes(spark):
    d = dictionary.chunk_dictionary(corpus(spark, words(6, 8, "abcd")))
    small, large = train_sizes(d, [266, 280])
    assert small.name == "regex_vocab_266" and large.merges[:10] == small.merges
    assert train(d, 266).tokenizer.merges == small.merges


def test_dictionary_positions_for_any_bigint_id(spark):
    texts = ["b a b", "a c", "b"]
    df = corpus(spark, texts)
    want = {}
    for d, t in enumerate(texts):
        for i, c in enumerate(model.pretokenize(t)):
            n, pos = want.get(c, (0, (d, i)))
            want[c] = (n + 1, pos)
    rows = dictionary.chunk_dictionary(df).collect()
    assert {r["chunk"]: (r["cnt"], (r["first_doc"], r["first_idx"])) for r in rows} == want
    for shift in (1 << 40, -(1 << 63), (1 << 63) - len(texts)):
        far = df.withColumn("doc_id", F.col("doc_id") + F.lit(shift))
        rows = dictionary.chunk_dictionary(far).collect()
        assert {r["chunk"]: (r["cnt"], (r["first_doc"] - shift, r["first_idx"])) for r in rows} == want
        assert train(dictionary.chunk_dictionary(far), 258).tokenizer == train(dictionary.chunk_dictionary(df), 258).tokenizer


def test_added_counts(spark):
    a = spark.createDataFrame([(1, 2, 3), (4, 5, 1)], "left int, right int, cnt long")
    b = spark.createDataFrame([(1, 2, 2)], "left int, right int, cnt long")
    rows = dictionary.add_counts(a, b, ["left", "right"]).collect()
    assert {(r["left"], r["right"]): r["cnt"] for r in rows} == {(1, 2): 5, (4, 5): 1}
