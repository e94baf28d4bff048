"""Small document tables with every awkward case."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = "river stone cloud winter bread market silver garden window paper candle forest harbour signal engine basket".split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + (r.choice(["", "", "", "s", ".", ","])) for _ in range(n))


def rows():
    base = prose(1, 60)
    near = base.replace("river", "rivers", 1)
    texts = [
        base,
        base,
        base.replace(" ", "\n\t"),
        near,
        prose(2, 40),
        None,
        "",
        "   \n",
        "one two",
        "ONE  two",
        "éclair été ñandú über straße " * 3,
        prose(3, 6000),
        prose(3, 6000) + " end",
        "x" * 20000,
        "a\x00b ​ c 日本語 \U0001f600",
    ]
    out = [(i, t, None if i == 4 else "en" if i % 2 else "fr", "src0", 0) for i, t in enumerate(texts)]
    out.append((0, base, "en", "src0", 0))  # the same row again
    out.append((None, base, None, None, None))
    return out


def frame(spark, data=None):
    """With extra columns whose names clash with those of the operators."""
    df = spark.createDataFrame(rows() if data is None else data, SCHEMA)
    from pyspark.sql import functions as F

    for name in ("kept", "digest", "text_sha256", "score", "p", "n", "hits", "row", "id", "component_id"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def empty(spark):
    return frame(spark, [])
