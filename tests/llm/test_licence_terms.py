"""Terms of a line: looked up in a set, and equal to their definition in plain Python."""

import re

from pyspark.sql import functions as F

from mergeloom.llm import licences

LINES = [
    "", "the", "the the THE", "of the license, version 2.0 of the license", "Released under the MIT License.", "under x the y license",
    "Copyright 2020 The Authors. Licensed under CC BY-NC 4.0.", "über the straße-a.b--c .d. 3-clause bsd", "of a\tcopy of a copy",
    " ".join(f"w{i}" for i in range(300)) + " this software and this software", "Ka b c all rights reserved", "no part", "mit",
]


def words_of(line):
    return re.findall(r"[a-z0-9]+(?:[.-][a-z0-9]+)*", line.lower())


def frame(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "line string")


def test_terms_are_those_of_the_definition(spark):
    known = licences.known_terms(spark)
    assert all(w in known for t in known for w in t.split(" "))
    got = {r.line: (r.words, r.terms) for r in licences.termed(frame(spark, LINES), known).collect()}
    for line in LINES:
        words = words_of(line)
        met = {*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))} & set(known)
        others = len({*words} - set(known))
        assert got[line] == (words, sorted(met) + [f"~{n}" for n in licences.OTHERS if others >= n]), line


def test_known_terms_are_not_gone_through_line_by_line(spark):
    known = licences.known_terms(spark)
    plan = licences.termed(frame(spark, LINES), known)._jdf.queryExecution().executedPlan().toString()
    # Before, every line met all known terms one by one, and a function of its own made pairs of all its words.
    assert "array_intersect" not in plan and "UDF" not in plan and "INSET" in plan


def test_has_run_is_the_overlap_of_runs(spark):
    listed = ["a b c", "of the license", "b c d", "no part"]
    lines = ["a b c", "x a b c y", "a b x c", "no part", "no part of", "part", "", "the license of the license", "c d", "z b c d"]
    words = licences.tokens(F.col("line"))
    rows = frame(spark, lines).withColumn("words", words)
    got = rows.select("line", licences.has_run(F.col("words"), listed).alias("has"), licences.runs(F.col("words")).alias("runs")).collect()
    assert len(got) == len(lines)
    assert all(r.has is bool({*r.runs} & {*listed}) for r in got), got


def test_a_word_of_very_many_parts(spark):
    line = "a." * 200_000 + "a mit"
    got = frame(spark, [line]).select(licences.tokens(F.col("line"))).first()[0]
    assert got == ["a." * 200_000 + "a", "mit"]
