"""The licence classifier is fitted on all lines of the corpus."""

from pyspark.sql import functions as F

from mergeloom.llm import licences

SCHEMA = "doc_id bigint, text string"


def test_every_ordinary_line_counts(spark):
    rows = [(i, f"the river number {i}\nwinter {'bread ' * (i % 40)}of the market") for i in range(600)]
    rows += [(1000, "Released under the MIT License.\nplain line"), (1001, None)]
    classifier = licences.train(spark.createDataFrame(rows, SCHEMA))
    # Two lines of each, one plain line, an empty one for the null text, and the fixed ones; not the notice.
    assert classifier.fitted == 1200 + 1 + 1 + len(licences._ORDINARY)


def test_runs(spark):
    texts = [(0, "a b c d b c d"), (1, "a b"), (2, ""), (3, "a b c")]
    got = dict(spark.createDataFrame(texts, SCHEMA).select("doc_id", licences.runs(licences.tokens(F.col("text")))).collect())
    assert got == {0: ["a b c", "b c d", "c d b", "d b c"], 1: ["a b"], 2: [""], 3: ["a b c"]}


def test_notices_with_names_of_their_own(spark):
    lines = ["Copyright 2019 Jane Q Doe. Released under the MIT License.", "Under the river, in the market of the winter."]
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(lines * 30)], SCHEMA)
    got = licences.decide(docs).select("families").collect()
    assert [r[0] for r in got].count("MIT") == 30 and [r[0] for r in got].count("") == 30
