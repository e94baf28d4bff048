import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from mergeloom.llm import alignment
from mergeloom.llm.encoding import tokenizer_path

import cases

ODD = ["a  b", " x", "tab\t x", "ﬁ ① ½", "▁x", "a\x00b", "<s> </s> <|endoftext|>", "日本 語 \U0001f600", "  ", "\n\n", "é" * 30, "it's  two", "x"]


def plain_tokens(text):
    """[(id, start, end)] of both tokenizers, or two empty lists."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = plain_tokens.a = getattr(plain_tokens, "a", None) or Tokenizer.from_file(tokenizer_path())
    a.encode_special_tokens = True
    b = plain_tokens.b = getattr(plain_tokens, "b", None) or sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    if not text:
        return [], []
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in printed} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in printed)}
    found = a.encode(" " + text, add_special_tokens=False)
    sides = [(found.ids, [bytes(byte[c] for c in t) for t in found.tokens]), (b.encode(text), [])]
    for i in sides[1][0]:
        p = b.id_to_piece(i)
        sides[1][1].append(bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode())
    out = []
    for ids, spelled in sides:
        if b"".join(spelled) != (" " + text).encode():
            return [], []
        ends = np.cumsum([len(s) for s in spelled]).tolist()
        out.append(list(zip(ids, [0, *ends], ends)))
    return out


def model(docs):
    tokens = [plain_tokens(t) for _, t in docs]
    links = [[(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x[1] < y[2] and y[1] < x[2]] for a, b in tokens]
    counts = Counter((a[i][0], b[j][0]) for (a, b), ls in zip(tokens, links) for i, j in ls)
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    out = []
    for (doc, _), (a, b), ls in zip(docs, tokens, links):
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        spelled = []
        for start, end in zip([0, *cuts], cuts):
            spelled.append("|".join(",".join(str(x[0]) for x in side if start < x[2] <= end) for side in (a, b)))
        pairs = [(a[i][0], b[j][0]) for i, j in ls]
        sha = hashlib.sha256(";".join(spelled).encode()).hexdigest() if a else ""
        out.append((doc, len(a), len(b), len(cuts), len(ls), sum(counts[p] == most[p[1]] for p in pairs), sum(counts[p] for p in pairs), sha))
    return sorted(out, key=str)


def table():
    rows = [r for r in cases.rows() if r[1] is None or len(r[1]) < 4000]
    return rows + [(100 + i, t, "en", "s", 0) for i, t in enumerate(ODD)]


@pytest.mark.parametrize("hot", [alignment.HOT_PAIRS, 40])
def test_against_the_definition(spark, monkeypatch, hot):
    """With few hot pairs, the rest take the shuffled join."""
    monkeypatch.setattr(alignment, "HOT_PAIRS", hot)
    got = alignment.decide(cases.frame(spark, table()))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = model([r[:2] for r in table()])
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert sum(w[1] == 0 for w in want) > 2  # null, empty, and changed by a tokenizer
    assert alignment.decide(cases.empty(spark)).count() == 0


def test_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("length(text) < 1500")
    want = model([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sorted(map(tuple, alignment.decide(docs).collect()), key=str) == want


def test_links_with_ranges(spark):
    rows = [r for r in table() if r[0] is not None and r[0] > 5]
    want = []
    for doc, text, *_ in rows:
        a, b = plain_tokens(text)
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                if x[1] < y[2] and y[1] < x[2]:
                    want.append((doc, i, j, x[0], y[0], sum(c < x[2] for c in cuts), max(x[1], y[1]), min(x[2], y[2])))
    assert sorted(map(tuple, alignment.align(cases.frame(spark, rows)).collect())) == sorted(want)


def test_a_very_long_text(spark):
    text = cases.prose(4, 300_000)
    row = alignment.decide(cases.frame(spark, [(1, text, "en", "s", 0)])).first()
    assert row.n_links == row.n_a + row.n_b - row.n_groups and row.n_groups > 200_000


def test_gallop_finds_every_rank():
    rng = np.random.default_rng(5)
    for _ in range(200):
        ends = np.sort(rng.choice(500, rng.integers(1, 60), replace=False))
        keys = np.sort(rng.integers(0, ends[-1] + 1, rng.integers(1, 40)))
        at = rng.integers(0, len(ends), len(keys))
        assert alignment.gallop(keys, ends, at).tolist() == np.searchsorted(ends, keys, "left").tolist()
