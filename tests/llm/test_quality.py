import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from mergeloom.llm import quality

import cases


def plain_features(text):
    """Some features by their definitions."""
    raw = (text or "").encode()
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    n, many = max(1, len(raw)), max(1, len(w))
    runs = ["".join(sorted(w[i : i + 8])) for i in range(len(w) - 7)]
    lines = [x.split() for x in re.split("\n", (text or "").lower())]
    lines = [" ".join(x) for x in lines if x]
    longest = max((len(m[0].split()) for m in re.finditer(r"(?<!\S)(\S+)(?: \1)*(?!\S)", " ".join(w))), default=1)
    return {
        "log_bytes": math.log1p(len(raw)),
        "capitals": sum(65 <= b < 91 for b in raw) / n,
        "breaks": raw.count(10) / n,
        "word_bytes": sum(len(x.encode()) for x in w) / many,
        "symbol_words": sum(x[-1] in "#$%&*+/<=>@[\\]^_`{|}~!?" for x in w) / many,
        "bare_words": sum(not any(c.isascii() and c.isalpha() or not c.isascii() for c in x) for x in w) / many,
        "distinct_words": len(set(w)) / many,
        "top_word": max((w.count(x) for x in set(w)), default=0) / many,
        "distinct_runs": len(set(runs)) / len(runs) if runs else float(bool(w)),
        "echoes": sum(a == b for a, b in zip(w, w[1:])) / many,
        "longest_echo": math.log(longest),
        "line_words": math.log1p(len(w) / (1 + raw.count(10))),
        "distinct_lines": len(set(lines)) / len(lines) if lines else 0.0,
    }


def test_features_by_definition():
    texts = [r[1] for r in cases.rows() if r[1] is None or len(r[1]) < 4000] + ["a | b | c", "AB!! CD!!\nab!! cd!!\n\nx", "no no no yes yes no", "12 34 ... é"]
    got = quality.features(pa.array(texts))
    assert got.shape == (len(texts), len(quality.FEATURES)) and np.isfinite(got).all()
    for text, row in zip(texts, got):
        for name, value in plain_features(text).items():
            assert math.isclose(row[quality.FEATURES.index(name)], value, abs_tol=1e-9), (name, text)


def split_loss(g, h):
    return sum(a.sum() ** 2 / (b.sum() + quality.RIDGE) for a, b in zip(g, h))


def test_trees_take_the_best_cuts():
    rng = np.random.default_rng(1)
    for _ in range(50):
        g, h = rng.normal(0, 3, 9), rng.uniform(0.5, 4, 9)
        cuts = [c for c in range(1, 9) if min(h[:c].sum(), h[c:].sum()) >= quality.LEAST_CURVATURE]
        gains = [split_loss([g[:c], g[c:]], [h[:c], h[c:]]) - split_loss([g], [h]) for c in cuts]
        gain, at = quality.best_cut(g, h)
        assert math.isclose(gain, max(0, *gains), abs_tol=1e-9) and (gain == 0 or at == cuts[int(np.argmax(gains))])
        leaves = quality.tree(g, h)
        for a, b in zip(np.flatnonzero(np.diff(leaves, prepend=np.nan) != 0), [*np.flatnonzero(np.diff(leaves)) + 1, 9]):
            assert math.isclose(leaves[a], -g[a:b].sum() / (h[a:b].sum() + quality.RIDGE), rel_tol=1e-9)
        assert len(set(leaves.tolist())) <= 4


def test_score_is_the_sum_of_lookups_and_learns_pairs():
    """Which texts are good shows in two features together only."""
    rng = np.random.default_rng(2)
    x = rng.uniform(0, 1, (4000, 5))
    good = ((x[:, 1] > 0.5) == (x[:, 3] > 0.5)).astype(float)
    m = quality.fit(x[:3000], good[:3000])
    assert (1, 3) in m.pairs
    s = m.score(x[3000:])
    assert ((s >= 0.5) == good[3000:]).mean() > 0.95
    for row in x[:50]:
        bins = [sum(e <= v for e in m.edges[f]) for f, v in enumerate(row)]
        raw = m.bias + sum(m.tables[f][b] for f, b in enumerate(bins))
        raw += sum(t[m.coarse[f][bins[f]], m.coarse[g][bins[g]]] for (f, g), t in zip(m.pairs, m.joint))
        assert math.isclose(m.raw(row[None])[0], raw, rel_tol=1e-9)


def test_quality(spark):
    rows = [(i, cases.prose(i, 40) if i % 4 else "!! ".join(cases.prose(i, 40).upper().split()), "en", "s", 0) for i in range(400)]
    rows += [(900, None, "en", "s", 0), (901, "", "en", "s", 0), (902, "word " * 30000, "en", "s", 0), (None, "a b", "en", "s", 0), (1, rows[1][1], "en", "s", 0)]
    labels = [(i, int(i % 4 > 0), 1) for i in range(400)] + [(3, None, 1), (None, 1, 1), (900, 0, 0), (7, 0, 0)]
    docs = cases.frame(spark, rows)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").withColumn("good", F.lit("clash")).withColumn("x", F.lit(1))
    got = quality.decide(docs, marks).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    by_id = {r.doc_id: r for r in got}
    assert sum(by_id[i].predicted == int(i % 4 > 0) for i in range(400)) > 395
    assert by_id[900].score == by_id[901].score and len({r.score for r in got if r.doc_id == 1}) == 1
    assert {i for i in by_id if by_id[i].held_out} == {i for i in by_id if __import__("zlib").crc32(str(i if i is not None else "").encode()) % 5 == 0}
    assert quality.decide(cases.empty(spark), marks).count() == 0
    assert {r.score < 1e-9 for r in quality.decide(docs, marks.limit(0)).collect()} == {True}
    assert {r.score > 0.99 for r in quality.decide(docs, marks.where("quality = 1")).collect()} == {True}


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality.decide(spark.read.parquet(f"{sf}/documents.parquet"), labels).where("held_out").join(labels.select("doc_id", "quality"), "doc_id")
    right = rows.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right > 0.9
