import random

import pytest
from pyspark.sql import functions as F

import model
from mergeloom.functions import codes, text as tx


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, text string")


def random_texts(n, seed=7):
    rng = random.Random(seed)
    alphabet = "ab Z'sLlé漢 \u0085　 \n\r\t12345²½😀!?.-_​"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(n)]


@pytest.mark.parametrize("pattern,expected", [(tx.GPT4_PATTERN, model.GPT4), (tx.GPT2_PATTERN, model.GPT2)])
def test_chunks_equal_python_regex(spark, pattern, expected):
    texts = model.ADVERSARIAL + random_texts(1500)
    rows = frame(spark, texts).select("id", tx.chunks("text", pattern).alias("c")).collect()
    got = {r["id"]: r["c"] for r in rows}
    for i, t in enumerate(texts):
        assert got[i] == model.pretokenize(t, expected), repr(t)
        assert "".join(got[i]) == t


def test_capture_groups_are_rejected():
    for bad in (r"(a)|b", r"(?P<x>a)", r"(?<x>a)"):
        with pytest.raises(ValueError):
            tx.chunks("text", bad)
    for good in (r"(?:a)|[(]", r"\(a", r"(?i:a)", r"a(?!b)", r"(?<!a)b", r"(?<=a)b"):
        assert not tx.has_capture_group(good)


def test_measures(spark):
    texts = model.ADVERSARIAL + random_texts(300)
    rows = frame(spark, texts).select("id", tx.byte_length("text").alias("b"), tx.word_count("text").alias("w"))
    import regex

    for r in rows.collect():
        assert r["b"] == len(texts[r["id"]].encode())
        assert r["w"] == len(regex.findall(r"\S+", texts[r["id"]]))


def test_byte_codes_and_ids(spark):
    texts = model.ADVERSARIAL + random_texts(300)
    rows = frame(spark, texts).select("id", codes.code_ids(codes.byte_codes("text")).alias("ids"))
    for r in rows.collect():
        assert r["ids"] == list(texts[r["id"]].encode())


def test_token_chars_skip_surrogates(spark):
    ids = [0, 255, 256, 0xD7FF, 0xD800, 0xDFFF, 65535, 100_257]
    assert [codes.char_token(codes.token_char(i)) for i in ids] == ids
    joined = "".join(map(codes.token_char, ids))
    row = spark.createDataFrame([(joined,)], "s string").select(codes.code_ids(F.col("s")).alias("i")).first()
    assert row["i"] == ids


def test_merge_is_left_to_right_without_overlap(spark):
    df = spark.createDataFrame([("aaa",), ("aaaaaaaa",), ("abab",)], "s string")
    out = df.select("s", codes.code_ids(codes.apply_merges(F.col("s"), [(97, 97)])).alias("i")).collect()
    got = {r["s"]: r["i"] for r in out}
    assert got == {"aaa": [256, 97], "aaaaaaaa": [256] * 4, "abab": [97, 98, 97, 98]}


def test_lossy_text_equals_python_replace(spark):
    rng = random.Random(3)
    raws = [bytes(rng.choice([0x41, 0xC3, 0xA9, 0xE6, 0xBC, 0xA2, 0xF0, 0x9F, 0x98, 0x80, 0xFF, 0xED, 0xA0]) for _ in range(rng.randrange(9))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(map(bytearray, raws))), "id int, b binary")
    for r in df.select("id", codes.lossy_text(F.col("b")).alias("t")).collect():
        assert r["t"] == raws[r["id"]].decode("utf-8", "replace")


def test_escape_controls(spark):
    import unicodedata

    texts = model.ADVERSARIAL
    for r in frame(spark, texts).select("id", codes.escape_controls(F.col("text")).alias("t")).collect():
        want = "".join(
            f"\\u{ord(c):04x}" if unicodedata.category(c).startswith("C") else c for c in texts[r["id"]]
        )
        assert r["t"] == want


def test_split_keeps_specials_in_order(spark):
    import re

    specials = ["<|a|>", "<|ab|>", "[x]*"]
    texts = ["", "<|a|>", "p<|a|><|ab|>q", "[x]*[x]*", "<|a<|a|>b|>", "tail <|ab|>"]
    df = frame(spark, texts).select("id", tx.split_keeping_specials(F.col("text"), specials).alias("p"))
    for r in df.collect():
        flat = [v for p in r["p"] for v in (p["part"], p["special"]) if v is not None]
        assert flat == re.split("(" + "|".join(map(re.escape, specials)) + ")", texts[r["id"]])
