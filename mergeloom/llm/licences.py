"""Licence scan: a trained paragraph classifier, in DataFrame operations only.

A paragraph is a line of text. Those of its words and word pairs that occur in a notice or a variant of one, and steps
of the number of its other words, are hashed into sparse binary features; a multinomial logistic regression gives the probability of each
licence family and of none. It is trained on the family notices below, with variants (a copyright
line in front, words left out, with words of its own), against all lines of the corpus that share no three-word run with a notice.
Lines with the same features are one to the model, so it is fitted on the distinct sets of features, weighted by their numbers of lines.

A line counts as licence text if its probability of none is below a threshold
calibrated on the sets held out of training, a quarter of all (no ordinary line among them passes, with a margin,
unless the threshold would exceed 0.9). It gets the
likeliest family if at least `CONFIRMED` of the three-word runs of one of the family's
notices occur in it, and is `unknown` otherwise.

Edge cases: null text has no lines. Rows that share a doc_id (null included) are one
document with the lines of all. An empty table gives an empty result; a corpus without
ordinary lines trains against a fixed few. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import cut_lineage, text_of

FEATURES = 1 << 14
# Numbers of words that no notice has; a notice in a corpus has names and years of its own.
OTHERS = (1, 4, 16, 64, 256)
OWN_WORDS = 6
CONFIRMED = 0.6
NONE = "none"
UNKNOWN = "unknown"
# Usual notices of common licences.
NOTICES = {
    "AGPL-3.0": ["This program is licensed under the GNU Affero General Public License, version 3."],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Released under the BSD 3-Clause License.",
    ],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "proprietary": ["All rights reserved. No part of this work may be reproduced without permission."],
}
FAMILIES = [NONE, *sorted(NOTICES)]
_ORDINARY = ["The first part of the text.", "A work of that year.", "It is of the same kind under the others.", "2.0", ""]


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[a-z0-9]++(?:[.-][a-z0-9]++)*+"), F.lit(0))


def runs(words: Column) -> Column:
    """Three-word runs; shorter texts as one run."""
    rest = lambda k: F.slice(words, k, 1 << 30)
    pairs = F.zip_with(words, rest(2), lambda a, b: F.concat(a, F.lit(" "), b))
    triples = F.zip_with(pairs, rest(3), lambda ab, c: F.concat(ab, F.lit(" "), c))
    return F.when(F.size(words) < 3, F.array(F.array_join(words, " "))).otherwise(F.array_distinct(F.array_compact(triples)))


def has_run(words: Column, listed: list[str]) -> Column:
    """Whether one of `runs(words)` is `listed`; only those that end like one are made."""
    ends = sorted({run.split(" ")[-1] for run in listed})
    run = lambda w, i: F.concat_ws(" ", F.get(words, i - 2), F.get(words, i - 1), w)
    met = F.exists(F.transform(words, lambda w, i: F.when((i > 1) & w.isin(ends), run(w, i)).otherwise("")), lambda r: (r != "") & r.isin(listed))
    return F.when(F.size(words) < 3, F.array_join(words, " ").isin(listed)).otherwise(met)


def _notices(spark: SparkSession) -> DataFrame:
    rows = [F.struct(F.lit(family).alias("family"), F.lit(text).alias("line")) for family, texts in sorted(NOTICES.items()) for text in texts]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("n")).select("n.*")


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, place (from 0) and text of every line."""
    return docs.select(docs["doc_id"], F.posexplode(F.split(text_of(docs), "\n")).alias("place", "line"))


def variants(notices: DataFrame) -> DataFrame:
    """family and line: each notice as it is, with a line before or after it, and with every fifth word left out."""
    words = F.split("line", " ")
    return notices.select(
        "family",
        F.explode(
            F.concat(
                F.array("line", F.concat(F.lit("Copyright 2020 The Authors. "), "line"), F.concat("line", F.lit(" See the file for details."))),
                F.transform(
                    F.sequence(F.lit(0), F.lit(4)),
                    lambda k: F.array_join(F.filter(words, lambda w, i: (i % 5) != k), " "),
                ),
            )
        ).alias("line"),
    )


def known_terms(spark: SparkSession) -> list[str]:
    """The words and pairs of all notices and their variants: a fixed list, whatever the corpus."""
    worded = variants(_notices(spark)).withColumn("words", tokens(F.col("line")))
    paired = NGram(n=2, inputCol="words", outputCol="pairs").transform(worded)
    return sorted(r.term for r in paired.select(F.explode(F.concat("words", "pairs")).alias("term")).distinct().collect())


def termed(rows: DataFrame, known: list[str]) -> DataFrame:
    """Adds `words` of column `line`, and `terms`: those `known` ones that it has, sorted, and a
    term for each of `OTHERS` that its number of other distinct words reaches.

    The words of a pair in `known` are in `known` themselves, so pairs are only made of such."""
    pairs = [t for t in known if " " in t]
    alone = [t for t in known if " " not in t]
    worded = rows.withColumn("words", tokens(F.col("line")))
    # Each word looked up in a set, null if unknown; the number of different words.
    marked = worded.withColumn("marked", F.transform("words", lambda w: F.when(w.isin(alone), w))).withColumn("others", F.size(F.array_distinct("words")))
    joined = F.transform("marked", lambda w, i: F.when(w.isNotNull(), F.concat(F.get("marked", i - 1), F.lit(" "), w)))
    terms = F.concat(F.array_compact("marked"), F.filter(joined, lambda p: p.isin(pairs)))
    met = marked.withColumn("terms", F.sort_array(F.array_distinct(terms))).drop("marked")
    counted = met.withColumn("others", F.col("others") - F.size(F.filter("terms", lambda t: ~F.contains(t, F.lit(" ")))))
    levels = [F.when(F.col("others") >= n, F.lit(f"~{n}")) for n in OTHERS]
    return counted.withColumn("terms", F.concat("terms", F.array_compact(F.array(*levels)))).drop("others")


def featured(rows: DataFrame) -> DataFrame:
    """Adds `features` of column `terms`."""
    return HashingTF(inputCol="terms", outputCol="features", numFeatures=FEATURES, binary=True).transform(rows)


@dataclass(frozen=True)
class Classifier:
    model: LogisticRegressionModel
    threshold: float  # least probability of being licence text
    known: list[str]  # terms that count
    fitted: int = 0  # ordinary lines, held out ones included


def train(docs: DataFrame) -> Classifier:
    spark = docs.sparkSession
    notices = _notices(spark)
    known = known_terms(spark)
    notice_runs = [r.run for r in notices.select(F.explode(runs(tokens(F.col("line")))).alias("run")).distinct().collect()]
    rows = termed(lines(docs).select("line"), known)
    # A run of three words that a notice has brings two of its pairs; runs are only made where that can be.
    pair = F.exists("terms", lambda t: F.contains(t, F.lit(" ")))
    touched = F.when(pair | (F.size("words") < 3), has_run(F.col("words"), notice_runs)).otherwise(F.lit(False))
    fixed = spark.range(1).select(F.explode(F.array(*map(F.lit, _ORDINARY))).alias("line"))
    # Counted by set of terms; filtered after that, or else the filter would split the lines into words once more.
    sets = rows.select("terms", (~touched).cast("bigint").alias("n")).groupBy("terms").agg(F.sum("n").alias("n"))
    ordinary = sets.unionByName(termed(fixed, known).select("terms", F.lit(1).cast("bigint").alias("n"))).where("n > 0")
    none = ordinary.select(F.lit(NONE).alias("family"), "terms", "n")
    held = (F.col("family") == NONE) & (F.pmod(F.xxhash64("terms"), F.lit(4)) == 0)
    code = F.array_position(F.array(*map(F.lit, FAMILIES)), F.col("family")).cast("double") - 1
    plain = variants(notices)
    own = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(OWN_WORDS)), lambda i: F.concat(F.lit("own-"), i.cast("string"))), " ")
    both = plain.unionByName(plain.select("family", F.concat_ws(" ", own, "line").alias("line")))
    every = termed(both, known).select("family", "terms", F.lit(1).cast("bigint").alias("n")).unionByName(none)
    rows = cut_lineage(every.select("family", "terms", "n", code.alias("label"), held.alias("held")), "licence-training")
    counted = rows.groupBy("label", "held").agg(F.sum("n").alias("n")).collect()
    weight = F.lit(0.0)
    for label, n in ((r.label, r.n) for r in counted if not r.held):
        weight = F.when(F.col("label") == label, F.col("n") / float(n)).otherwise(weight)
    fit_rows = featured(rows.where("not held")).select("label", weight.alias("weight"), "features")
    model = LogisticRegression(family="multinomial", weightCol="weight", maxIter=40, regParam=0.002, standardization=False).fit(fit_rows)
    seen = model.transform(featured(rows.where("held"))).select((1 - vector_to_array("probability")[0]).alias("p"))
    highest = seen.agg(F.max("p")).first()[0] or 0.0
    fitted = sum(r.n for r in counted if r.label == 0)
    return Classifier(model, min(0.9, max(0.5, 1.1 * highest)), known, fitted)


def found(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """doc_id, place, family, probability, similarity of every licence line."""
    scored = classifier.model.transform(featured(termed(lines(docs), classifier.known))).select(
        "doc_id", "place", "line", vector_to_array("probability").alias("p"), F.monotonically_increasing_id().alias("row")
    )
    # A filter isn't pushed below a row number: there it would split the lines into words and score them once more.
    likely = scored.where((1 - F.col("p")[0] >= classifier.threshold) & (F.col("row") >= 0)).select(
        "doc_id", "place", "line", F.slice("p", 2, len(FAMILIES) - 1).alias("p")
    )
    names = F.array(*map(F.lit, FAMILIES[1:]))
    likely = likely.select(
        "doc_id",
        "place",
        F.element_at(names, F.array_position("p", F.array_max("p")).cast("int")).alias("likeliest"),
        F.array_max("p").alias("probability"),
        runs(tokens(F.col("line"))).alias("runs"),
    )
    notices = _notices(docs.sparkSession).select(F.col("family").alias("likeliest"), runs(tokens(F.col("line"))).alias("notice"))
    notices = notices.groupBy("likeliest").agg(F.collect_list("notice").alias("notices"))
    compared = likely.join(F.broadcast(notices), "likeliest").withColumn(
        "similarity",
        F.array_max(F.transform("notices", lambda n: F.size(F.array_intersect("runs", n)) / F.size(n))),
    )
    family = F.when(F.col("similarity") >= CONFIRMED, F.col("likeliest")).otherwise(UNKNOWN)
    return compared.select("doc_id", "place", family.alias("family"), "probability", "similarity")


def decide(docs: DataFrame) -> DataFrame:
    """doc_id, n_found, families (sorted, comma-joined) and lines (place:family,
    in order) for every row."""
    hits = found(docs, train(docs)).select("doc_id", "place", "family").distinct()
    per_doc = hits.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("place", "family"))).alias("hits"))
    per_doc = per_doc.withColumnRenamed("doc_id", "id")
    rows = docs.select(docs["doc_id"]).join(per_doc, F.col("doc_id").eqNullSafe(F.col("id")), "left")
    return rows.select(
        "doc_id",
        F.coalesce(F.size("hits"), F.lit(0)).cast("bigint").alias("n_found"),
        F.coalesce(F.array_join(F.array_sort(F.array_distinct("hits.family")), ","), F.lit("")).alias("families"),
        F.coalesce(
            F.array_join(F.transform("hits", lambda h: F.concat_ws(":", h["place"].cast("string"), h["family"])), ","), F.lit("")
        ).alias("lines"),
    ).withColumn("n_found", F.greatest("n_found", F.lit(0)))
