from pyspark.sql import functions as F

from mergeloom.operators.joins import join_bounded, measured_bytes


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_broadcast_depends_on_measured_size(spark):
    left = spark.range(1000).withColumn("k", F.col("id") % 7)
    small = spark.range(7).select(F.col("id").alias("k"), F.lit("x" * 100).alias("v"))
    near, far = join_bounded(left, small, "k"), join_bounded(left, small, "k", limit=100)
    assert "strategy=broadcast" in plan(near) and "strategy=broadcast" not in plan(far)
    assert near.exceptAll(far).count() == 0 and near.count() == far.count() == 1000


def test_long_values_count(spark):
    df = spark.createDataFrame([("a" * 1000, [1] * 50), (None, None)], "s string, a array<int>")
    assert 1000 + 50 * 16 <= measured_bytes(df) <= 1000 + 50 * 16 + 100
    assert measured_bytes(df.limit(0)) == 0
    nested = df.select(F.array("s", "s").alias("list"), F.struct("s", F.array(F.struct("s")).alias("in")).alias("x"), F.create_map(F.lit("k"), "s").alias("m"))
    assert 5 * 1000 <= measured_bytes(nested) <= 5 * 1000 + 700


def test_shuffle_paths_give_the_same_results(spark, monkeypatch):
    """Everything that may broadcast also works when nothing does."""
    import mergeloom.operators.joins as joins
    from mergeloom.operators import dictionary, prefix
    from mergeloom.sources import corpus

    rows = [(i, "ab"[i % 5 == 0], t) for i, t in enumerate(["x", " \n y", "", "z\n", "  ", "q", "\n\nw"] * 5)]
    df = spark.createDataFrame(rows, "doc_id long, g string, text string")

    def results():
        pieces = dictionary.exploded_chunks(corpus.with_separators(df, "g"), keep=["g", "doc_id"])
        index = prefix.dense_index(df.select("doc_id", "g"), "doc_id", "i", ["g"])
        return [sorted(map(tuple, d.collect())) for d in (pieces, index)]

    want = results()
    monkeypatch.setattr(joins.join_bounded, "__defaults__", ("inner", -1))
    assert results() == want
