"""The pipeline against the operators' plain-Python models."""

from collections import defaultdict

import corpus_pipeline
from mergeloom.llm import language_id, queries, sqls

import cases
from test_dedup import exact_model, near_model
from test_text_operators import leak_model
from test_tokens import reference


def test_stages_on_every_awkward_case(spark, tmp_path):
    docs = cases.frame(spark)
    items = spark.createDataFrame([(1, cases.prose(2, 40))], "item_id bigint, text string")
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    for data in (docs, cases.empty(spark)):
        data.write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
        read = spark.read.parquet(str(tmp_path / "documents.parquet"))
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, read, str(tmp_path)).columns == docs.columns, name
        corpus_pipeline.run(spark, str(tmp_path)).count()


def test_against_models(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    frame = spark.read.parquet(f"{sf}/documents.parquet")
    spoken = {r.doc_id for r in language_id.accepted(frame).select("doc_id").collect()}
    assert len(spoken) == len(docs)  # every text here is in one of the languages
    kept = {r[0] for r in exact_model(docs) if r[3]}
    rest = [d for d in docs if d[0] in kept]
    kept = {r[0] for r in near_model(rest) if r[3]}
    rest = [d for d in rest if d[0] in kept]
    clean = {r[0] for r in leak_model(rest, items) if not r[-1]}
    want = {d: len(reference(t)) + 1 for d, t in rest if d in clean}
    got = defaultdict(int)
    for p in corpus_pipeline.run(spark, sf).collect():
        got[p.doc_id] += p.length
    assert dict(got) == want


def test_reused_and_repeated_ids(spark, tmp_path):
    """Every unique text is packed once, whatever its id."""
    text = [cases.prose(i, 60) for i in range(4)]
    rows = [(1, text[0]), (1, text[0]), (2, text[0]), (2, text[1]), (2, text[2]), (None, text[3]), (None, text[3]), (None, text[0])]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], cases.SCHEMA)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, cases.prose(90, 40))], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = defaultdict(int)
    for p in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got[p.doc_id] += p.length
    size = [len(reference(t)) + 1 for t in text]
    # The null id's copy of text 0 goes, its own text stays once.
    assert dict(got) == {1: size[0], 2: size[1] + size[2], None: size[3]}


def test_registered_names():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, len(names) + 1)] and len(names) >= 11
    assert set(sqls.sql()) <= set(names)
