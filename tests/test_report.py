import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import model
from mergeloom.operators import codec, dictionary, report
from mergeloom.operators.bpe_train import train
from mergeloom.operators.tokenizer import Tokenizer
from mergeloom.sources import corpus, models

TEXTS = ["the cat sat on the mat. the end", "thé chat\n\nsat  12345", "aaa aaa"]


@pytest.fixture(scope="module")
def tok(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    return train(dictionary.chunk_dictionary(docs), 266, "t10").tokenizer


def expected(text, tok, n):
    ids = model.encode(text, tok.merges)
    counts, size, words = Counter(ids), len(text.encode()), len(text.split())
    top = counts.most_common(n)
    entropy = -sum(c / len(ids) * math.log2(c / len(ids)) for c in counts.values())
    return {
        "bytes": size, "words": words, "tokens": len(ids), "unique_tokens": len(counts),
        "compression_ratio": size / len(ids), "compression_pct": 1 - len(ids) / size,
        "tokens_per_word": len(ids) / words, "tokens_per_kb": len(ids) / (size / 1024),
        "vocab_coverage": len(counts) / 266, "entropy_bits_per_token": entropy,
        "effective_vocab_size": 2**entropy if entropy else 0,
        "token_reuse_rate": 1 - len(counts) / len(ids),
        "most_common_token_share": top[0][1] / len(ids),
        f"top_{n}_token_share": sum(c for _, c in top) / len(ids),
        "byte_token_share": sum(c for t, c in counts.items() if t < 256) / len(ids),
        "top_tokens": top,
    }


def check(row, want):
    for field, value in want.items():
        got = row[field]
        if field == "top_tokens":
            got = [(t["id"], t["cnt"]) for t in got]
            assert got == value
        else:
            assert got == pytest.approx(value), field


def test_report_equals_model(spark, tok):
    rows = [("x", 1, TEXTS[0]), ("x", 5, TEXTS[1]), ("y", 2, TEXTS[2])]
    samples = spark.createDataFrame(rows, "sample string, doc_id long, text string")
    got = {r["sample"]: r for r in report.compare_tokenizers(samples, [tok], 5, True).collect()}
    check(got["x"], expected(TEXTS[0] + "\n\n" + TEXTS[1], tok, 5))
    check(got["y"], expected(TEXTS[2], tok, 5))
    assert got["x"]["roundtrip"] is True and got["x"]["vocab_size"] == 266
    plain = report.compare_tokenizers(samples, [tok], 5, joined=False).filter("sample = 'y'").first()
    assert plain["roundtrip"] is None


def test_one_token_and_empty_samples(spark):
    tok = Tokenizer("none")
    rows = [("one", 1, "a"), ("empty", 2, "")]
    samples = spark.createDataFrame(rows, "sample string, doc_id long, text string")
    got = {r["sample"]: r for r in report.compare_tokenizers(samples, [tok]).collect()}
    assert got["one"]["effective_vocab_size"] == 0 and got["one"]["tokens"] == 1
    assert got["empty"]["tokens"] == 0 and got["empty"]["compression_ratio"] is None
    assert got["empty"]["bytes_per_token"] == 0 and got["empty"]["token_reuse_rate"] == 0


def test_two_patterns_side_by_side(spark, tok):
    other = Tokenizer("gpt2", tok.merges, model.GPT2)
    samples = spark.createDataFrame([("x", 1, TEXTS[1])], "sample string, doc_id long, text string")
    got = {r["tokenizer"]: r["tokens"] for r in report.compare_tokenizers(samples, [tok, other]).collect()}
    assert got == {
        "t10": len(model.encode(TEXTS[1], tok.merges)),
        "gpt2": len(model.encode(TEXTS[1], tok.merges, model.GPT2)),
    }


def test_outside_encoders(spark, tok):
    samples = spark.createDataFrame([("x", 1, TEXTS[0])], "sample string, doc_id long, text string")
    encoders = {"own": lambda c: codec.encode_column(tok, c), "bytes": codec.external_encoder(lambda s: s.encode())}
    got = {r["tokenizer"]: r for r in report.compare_encoders(samples, encoders, {"own": 266}, 5).collect()}
    check(got["own"], expected(TEXTS[0], tok, 5))
    assert got["bytes"]["tokens"] == len(TEXTS[0]) and got["bytes"]["vocab_coverage"] is None


def test_specials_in_samples_fail_the_report(spark, tok):
    samples = spark.createDataFrame([("x", 1, "some <|s|> text")], "sample string, doc_id long, text string")
    with pytest.raises(Exception, match="special token in text"):
        report.compare_tokenizers(samples, [tok.with_specials({"<|s|>": 900})]).collect()
    assert report.compare_tokenizers(samples, [tok], check_roundtrip=True).first()["roundtrip"] is True


def test_outside_encoders_run_once(spark):
    """Counts and round trip come from one encoding of each text."""
    calls = spark.sparkContext.accumulator(0)

    def encode(text):
        calls.add(1)
        return list(text.encode())

    samples = spark.createDataFrame([("x", i, f"text {i}") for i in range(20)], "sample string, doc_id long, text string")
    encoders = {"raw": codec.external_encoder(encode)}
    rows = report.compare_encoders(samples, encoders, {}, decoders={"raw": codec.external_decoder(lambda ids: bytes(ids).decode())})
    assert rows.first()["roundtrip"] is True and calls.value == 20


def test_samples(spark, tmp_path):
    items = spark.createDataFrame([(7, "b"), (3, "a")], "item_id long, text string")
    got = {r["sample"]: r["text"] for r in corpus.numbered_samples(items, "item_id").collect()}
    assert got == {"sample_0": "a", "sample_1": "b"}
    (tmp_path / "one.txt").write_text("line\nline 2\n")
    (tmp_path / "two.txt").write_text("x")
    got = {r["sample"]: r["text"] for r in corpus.whole_file_samples(spark, str(tmp_path)).collect()}
    assert got == {"one": "line\nline 2\n", "two": "x"}


def spaced_docs(seed):
    rng = random.Random(seed)
    return ["".join(rng.choice("a !\n\n \r\t7") for _ in range(rng.choice([0, 0, 1, 2, 5, 9]))) for _ in range(60)]


@pytest.mark.parametrize("pattern", [model.GPT4, model.GPT2])
def test_pieces_give_the_chunks_of_the_joined_text(spark, pattern):
    cases = [["a  ", "b\n", "!", "", "  c", "d"], ["", "", ""], [" \n", "\n x"], ["only"], ["x", " "]]
    for texts in cases + [spaced_docs(s) for s in range(4)]:
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        pieces = corpus.with_separators(df, pattern=pattern)
        rows = dictionary.exploded_chunks(pieces, pattern).collect()
        got = [r["chunk"] for r in sorted(rows, key=lambda r: (r["doc_id"], r["chunk_idx"]))]
        assert got == model.pretokenize("\n\n".join(texts), pattern), texts


def dictionary_model(texts, pattern):
    """Chunks of the joined text with counts."""
    return Counter(model.pretokenize("\n\n".join(texts), pattern))


@pytest.mark.parametrize("pattern", [model.GPT4, model.GPT2])
def test_joined_dictionary_in_one_scan(spark, pattern):
    """Equal to the dictionary of the pieces, first positions included, and to the joined text's chunks."""
    cases = [["a  ", "b\n", "!", "", "  c", "d"], ["", "", ""], [" \n", "\n x"], ["only"], ["x", " "], ["  lead", "y!"], ["a.\n \t", "\r\n"]]
    for texts in cases + [spaced_docs(s) for s in range(4)]:
        df = spark.createDataFrame([(3 * i - 50, t) for i, t in enumerate(texts)], "doc_id long, text string")
        got = {r["chunk"]: (r["cnt"], r["first_doc"], r["first_idx"]) for r in corpus.joined_dictionary(df, pattern).collect()}
        pieces = dictionary.chunk_dictionary(corpus.with_separators(df, pattern=pattern), pattern)
        assert got == {r["chunk"]: (r["cnt"], r["first_doc"], r["first_idx"]) for r in pieces.collect()}, texts
        assert {c: v[0] for c, v in got.items()} == dictionary_model(texts, pattern), texts
    assert corpus.joined_dictionary(df.limit(0), pattern).count() == 0


def test_one_scan_of_the_text(spark, tmp_path):
    """Of all plans that Spark runs for the dictionary, one reads the text."""
    path = str(tmp_path / "docs")
    spark.createDataFrame([(i, t) for i, t in enumerate(spaced_docs(3))], "doc_id long, text string").write.parquet(path)
    docs = spark.read.parquet(path)
    counted = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    corpus.joined_dictionary(docs.mapInArrow(seen, docs.schema)).collect()
    assert counted.value == 2 * docs.count()  # for the ends of the corpus, where a scan reads ids only, and for the text
    plan = docs.groupBy().agg(F.min("doc_id"), F.max("doc_id"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint>" in plan


def test_pieces_and_joined_text_by_group(spark, tmp_path):
    texts = spaced_docs(9)
    df = spark.createDataFrame([(i, "xyz"[i % 3], t) for i, t in enumerate(texts)], "doc_id long, g string, text string")
    whole = {g: "\n\n".join(texts[k::3]) for k, g in enumerate("xyz")}
    rows = dictionary.exploded_chunks(corpus.with_separators(df, "g"), keep=["g", "doc_id"]).collect()
    counts = {(r["g"], r["chunk"]): r["cnt"] for r in corpus.joined_dictionary(df, group="g").collect()}
    for g in "xyz":
        got = sorted((r["doc_id"], r["chunk_idx"], r["chunk"]) for r in rows if r["g"] == g)
        assert [c for _, _, c in got] == model.pretokenize(whole[g])
        assert {c: n for (h, c), n in counts.items() if h == g} == Counter(model.pretokenize(whole[g]))


@pytest.mark.parametrize("part_bytes", [40, 1 << 20])
def test_ordered_export(spark, tmp_path, part_bytes):
    """Files read in the manifest's order give each label's joined text."""
    texts = [t + "é" for t in spaced_docs(2)] + ["", "x" * 30_000, None]
    rows = [(100 - i, ["x", "y", None][i % 3], t) for i, t in enumerate(texts)]
    path = str(tmp_path / "joined")
    manifest = corpus.export_joined(spark.createDataFrame(rows, "doc_id long, g string, text string"), "g", path, part_bytes).collect()
    pieces = corpus.exported_pieces(spark, path).collect()
    digests = {r["label"]: r for r in corpus.exported_digests(spark, path).collect()}
    for label in ("x", "y", None):
        mine = sorted((d, t) for d, g, t in rows if g == label and t is not None)
        want = "\n\n".join(t for _, t in mine).encode()
        got = sorted((r["part"], r["at"], bytes(r["content"])) for r in pieces if r["label"] == label)
        assert b"".join(c for *_, c in got) == want
        assert (digests[label]["bytes"], digests[label]["digest"]) == (len(want), hashlib.md5(want).hexdigest())
        stretches = sorted((r["part"], r["first_doc"], r["docs"]) for r in manifest if r["label"] == label)
        assert sum(n for *_, n in stretches) == len(mine) and stretches[0][1] == mine[0][0]
    parts = {r["part"] for r in manifest}
    assert (len(parts) > 5) == (part_bytes == 40)


def test_other_patterns_keep_the_separator_with_its_document(spark):
    df = spark.createDataFrame([(0, "a"), (1, " b")], "doc_id long, text string")
    rows = corpus.with_separators(df, pattern=r"\S+").collect()
    assert {r["doc_id"]: r["text"] for r in rows} == {0: "a\n\n", 1: " b"}


def test_model_files_round_trip(spark, tok, tmp_path):
    named = tok.with_specials({"<|endoftext|>": 266, "<|x|>": 267})
    models.save_model(spark, named, str(tmp_path))
    models.save_model(spark, tok.prefix(260, "t4"), str(tmp_path))
    loaded = {t.name: t for t in models.load_models(spark, f"{tmp_path}/*.model")}
    assert loaded == {"t10": named, "t4": tok.prefix(260, "t4")}


def test_foreign_model_file_and_bad_header(spark, tmp_path):
    # Fixed format: header, pattern, number of specials, specials, merges.
    (tmp_path / "m.model").write_text("minbpe v1\n\\S+\n1\n<|e|> 900\n97 98\n256 99\n")
    (t,) = models.load_models(spark, f"{tmp_path}/*.model")
    assert t == Tokenizer("m", ((97, 98), (256, 99)), "\\S+", {"<|e|>": 900})
    assert t.vocab[257] == b"abc" and t.vocab[900] == b"<|e|>"
    (tmp_path / "bad.model").write_text("other v2\nx\n0\n")
    with pytest.raises(Exception, match="not a tokenizer model"):
        models.load_models(spark, f"{tmp_path}/bad.model")


def test_vocab_listing(spark, tmp_path):
    t = Tokenizer("v", ((104, 105), (256, 10)), specials={"<|e|>": 258})
    lines = {r["id"]: r["line"] for r in models.vocab_listing(spark, [t]).collect()}
    assert len(lines) == 259
    assert lines[0] == "[\\u0000] 0" and lines[200] == "[�] 200" and lines[104] == "[h] 104"
    assert lines[256] == "[h][i] -> [hi] 256" and lines[257] == "[hi][\\u000a] -> [hi\\u000a] 257"
    assert lines[258] == "[<|e|>] 258"
    models.save_vocab(spark, t, str(tmp_path))
    saved = [r["value"] for r in spark.read.text(f"{tmp_path}/v.vocab").collect()]
    assert saved == [lines[i] for i in range(259)]


def test_train_save_load_report(spark, tmp_path):
    from mergeloom.plans.comparison import report_on_models, train_and_save

    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    made = train_and_save(docs, [258, 262], str(tmp_path / "models"))
    samples = docs.withColumn("sample", F.lit("s"))
    rows = report_on_models(samples, str(tmp_path / "models"), str(tmp_path / "report")).collect()
    tokens = {r["tokenizer"]: r["tokens"] for r in rows}
    whole = "\n\n".join(TEXTS)
    assert tokens == {t.name: len(model.encode(whole, t.merges)) for t in made}


def test_distinct_sketches_merge(spark, tmp_path):
    """Stored batches merge to the sketch of all, whatever the batches are."""
    rows = spark.range(60_000).select(
        (F.col("id") % 2).cast("string").alias("sample"), F.lit("t").alias("tokenizer"), (F.col("id") % 7).alias("batch"),
        F.array((F.col("id") * 37 % 20_011).cast("int"), F.lit(5), (F.col("id") % 900).cast("int")).alias("tokens"),
    )
    path = str(tmp_path / "sketches")
    for batch in range(7):
        report.add_sketches(rows.where(F.col("batch") == batch), path)
    stored = spark.read.schema("sample string, tokenizer string, sketch binary").parquet(path)
    assert stored.count() == 14
    merged = {r["sample"]: r["unique_estimate"] for r in report.estimated_distinct(stored).collect()}
    whole = report.distinct_sketches(rows, ["sample", "tokenizer"])
    assert merged == {r["sample"]: r["unique_estimate"] for r in report.estimated_distinct(whole).collect()}
    again = {r["sample"]: r["unique_estimate"] for r in report.estimated_distinct(stored.unionByName(whole)).collect()}
    assert again == merged  # seeing tokens twice changes nothing
    exact = {r["sample"]: r["n"] for r in rows.select("sample", F.explode("tokens").alias("id")).groupBy("sample").agg(F.count_distinct("id").alias("n")).collect()}
    assert all(abs(merged[s] - exact[s]) <= report.SKETCH_ERROR * exact[s] for s in exact)
