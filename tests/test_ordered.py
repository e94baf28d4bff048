import random

import pytest
from pyspark.sql import functions as F

import model
from mergeloom.operators import batches, packing
from mergeloom.operators.prefix import dense_index, range_bounds, range_index, running
from mergeloom.operators.quota import quota_cuts, quota_split
from mergeloom.sources import shards


def test_range_index_is_a_lower_bound(spark):
    for bounds in ([], [5], [1, 4, 9], list(range(0, 1000, 7))):
        df = spark.range(-5, 1100).select("id", range_index("id", bounds).alias("r"))
        for r in df.collect():
            assert r["r"] == sum(b <= r["id"] for b in bounds)


@pytest.mark.parametrize("parts", [1, 2, 7, 64])
def test_running_equals_loop(spark, parts):
    rng = random.Random(parts)
    keys = rng.sample(range(-10_000, 10_000), 400)
    rows = [(k, rng.choice("aab"), rng.randrange(-5, 9)) for k in keys]
    df = spark.createDataFrame(rows, "k long, g string, v long")
    cols = {
        "before": ("sum", F.col("v"), False),
        "through": ("sum", F.col("v"), True),
        "low": ("min", F.col("v"), True),
        "prev_high": ("max", F.col("v"), False),
    }
    got = {r["k"]: r for r in running(df, "k", cols, ["g"], parts).collect()}
    state = {}
    for k, g, v in sorted(rows):
        total, low, high = state.get(g, (0, None, None))
        r = got[k]
        assert (r["before"], r["through"], r["prev_high"]) == (total, total + v, high)
        low = v if low is None else min(low, v)
        assert r["low"] == low
        state[g] = (total + v, low, v if high is None else max(high, v))
    assert len(got) == 400


def test_dense_index(spark):
    df = spark.createDataFrame([(9,), (2,), (100,)], "k long")
    assert {r["k"]: r["i"] for r in dense_index(df, "k", "i").collect()} == {2: 0, 9: 1, 100: 2}


def test_one_group_is_spread_over_ranges(spark):
    df = spark.range(10_000)
    bounds = range_bounds(df, "id", 16)
    sizes = [r["count"] for r in df.groupBy(range_index("id", bounds)).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 10_000 / 16


@pytest.mark.parametrize("targets", [(10, 10), (0, 0), (0, 5), (7, 0), (12, 3), (1000, 10), (10, 1000)])
def test_quota_equals_greedy_loop(spark, targets):
    rng = random.Random(sum(targets))
    for sizes in ([rng.randrange(0, 7) for _ in range(30)], [10, 10, 0, 3], [4, 8, 0, 3, 0, 9]):
        docs = spark.createDataFrame([(i * 3, "x" * n) for i, n in enumerate(sizes)], "doc_id long, text string")
        want = model.quota(sizes, *targets)
        got = {r["doc_id"]: r["split"] for r in quota_split(docs, *targets).collect()}
        assert got == {i * 3: s for i, s in enumerate(want)}


def test_quota_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert quota_cuts(docs) == (None, None)
    assert quota_split(docs).count() == 0


def token_docs(spark, docs):
    rows = [(i, d, len(d)) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "doc_id long, tokens array<int>, n_tokens int")


def packed(spark, docs, size):
    out = {}
    for r in packing.pack_shards(token_docs(spark, docs), size).collect():
        out.setdefault((r["split"], r["shard_id"]), []).append((r["start"], r["tokens"]))
    return {k: [t for _, p in sorted(v) for t in p] for k, v in out.items()}


def test_packing_equals_stream_cut(spark):
    rng = random.Random(8)
    cases = [
        ([[1, 2, 3], [4, 5, 6]], 3),  # exact fit
        ([list(range(25))], 4),  # longer than several shards
        ([[1, 2], [3, 4, 5]], 4),  # remainder
        ([[0] * 3, [1] * 8], 4),  # leftover larger than one shard
        ([[9] for _ in range(7)], 1),
        ([list(range(rng.randrange(1, 12))) for _ in range(40)], 9),
    ]
    for docs, size in cases:
        want = model.pack(docs, size)
        got = packed(spark, docs, size)
        assert got == {("val" if i == 0 else "train", i): s for i, s in enumerate(want)}


def test_shards_round_trip_and_prune(spark, tmp_path):
    docs = token_docs(spark, [list(range(10)), list(range(7))])
    path = str(tmp_path / "shards")
    shards.write_shards(packing.pack_shards(docs, 5), path)
    assert shards.read_shards(spark, path).count() == 4
    train = shards.read_shards(spark, path, "train")
    plan = train._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    assert [r["name"] for r in shards.list_shards(train).collect()] == [
        "tokens_train_000001", "tokens_train_000002", "tokens_train_000003",
    ]
    with pytest.raises(ValueError):
        shards.read_shards(spark, path, "dev")


def test_next_tokens(spark):
    pieces = packing.pack_shards(token_docs(spark, [[1, 2, 3], [4], [5, 6, 7, 8]]), 5)
    got = {(r["shard_id"], r["start"]): r["labels"] for r in packing.next_tokens(pieces).collect()}
    assert got == {(0, 0): [2, 3, 4], (0, 3): [5], (0, 4): [None], (1, 0): [7, 8, None]}


def labelled(docs, size):
    """Successors in each shard of the plain stream."""
    return {i: [*s[1:], None] for i, s in enumerate(model.pack(docs, size))}


@pytest.mark.parametrize("parts,batch", [(1, 10_000), (5, 3), (9, 1)])
def test_next_tokens_over_partitions(spark, tmp_path, parts, batch):
    """Shuffled one-token pieces, long ones over several shards, pieces without tokens, and a shard of its own."""
    rng = random.Random(parts)
    docs = [[rng.randrange(99) for _ in range(rng.choice([1, 1, 1, 2, 5, 23]))] for _ in range(60)] + [[7]]
    packed = packing.pack_shards(token_docs(spark, docs), 11)
    empty = packed.limit(2).withColumn("tokens", F.array().cast("array<int>")).withColumn("n_tokens", F.lit(0))
    empty = empty.withColumn("shard_id", F.lit(1)).withColumn("split", F.lit("train")).withColumn("start", F.lit(4).cast("bigint"))
    path = str(tmp_path / "pieces")
    packed.unionByName(empty).withColumn("r", F.rand(3)).repartition(parts, "r").drop("r").write.parquet(path)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        rows = packing.next_tokens(spark.read.parquet(path)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = {}
    for r in sorted(rows, key=lambda r: (r.shard_id, r.start)):
        assert len(r.labels) == len(r.tokens) == r.n_tokens
        got.setdefault(r.shard_id, []).extend(r.labels)
    assert got == labelled(docs, 11)
    assert packing.next_tokens(packed.limit(0)).count() == 0


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_token_array_is_shuffled_for_labels(spark, tmp_path):
    path = str(tmp_path / "shards")
    shards.write_shards(packing.pack_shards(token_docs(spark, [list(range(9))] * 20), 25), path)
    plan = executed(packing.next_tokens(shards.read_shards(spark, path)))
    exchanges = [line for line in plan.split("\n") if "Exchange" in line]
    assert exchanges and all("BroadcastExchange" in line for line in exchanges)


def test_manifest_holds_the_lengths(spark, tmp_path):
    path = str(tmp_path / "shards")
    shards.write_shards(packing.pack_shards(token_docs(spark, [list(range(9))] * 20), 25), path)
    pieces = shards.read_shards(spark, path)
    counted = {(r.split, r.shard_id): r.n for r in pieces.groupBy("split", "shard_id").agg(F.sum(F.size("tokens")).alias("n")).collect()}
    assert {(r.split, r.shard_id): r.n_tokens for r in shards.read_manifest(spark, path).collect()} == counted
    assert {r.shard_id for r in shards.read_manifest(spark, path, "val").collect()} == {0}
    assert "tokens:array" not in executed(packing.shard_lengths(pieces))


@pytest.mark.parametrize("B,T,world", [(1, 5, 3), (2, 3, 1), (2, 2, 2)])
def test_batches_equal_cursor(spark, B, T, world):
    rng = random.Random(B * 10 + world)
    total, size = 230, 61
    stream = [rng.randrange(999) for _ in range(total)]
    docs, at = [], 0
    while at < total:
        n = rng.randrange(1, 23)
        docs.append(stream[at : at + n])
        at += n
    pieces = packing.pack_shards(token_docs(spark, docs), size).cache()
    lens = packing.shard_lengths(pieces)
    got = {}
    for r in batches.batch_rows(pieces, lens, B, T, world).collect():
        got[r["shard_id"], r["rank"], r["batch_idx"], r["row"]] = (r["x"], r["y"])
    shard = model.pack(docs, size)
    want = {}
    for rank in range(world):
        seen = {}
        for s, pos in model.serve([len(x) for x in shard], B * T, world, rank):
            k = seen.get(s, 0)
            seen[s] = k + 1
            for row in range(B):
                w = shard[s][pos + row * T : pos + row * T + T + 1]
                if len(w) == T + 1:
                    want[s, rank, k, row] = (w[:-1], w[1:])
    assert got == want
    pieces.unpersist()


def test_ranks_may_disagree_on_batch_count(spark):
    lens = spark.createDataFrame([("train", 1, 61)], "split string, shard_id int, n_tokens long")
    rows = batches.shard_batches(lens, 1, 5, 3).orderBy("rank").collect()
    assert [r["n_batches"] for r in rows] == [4, 3, 3]


def test_schedule_cycles_through_shards(spark):
    lens = spark.createDataFrame([("train", 1, 11), ("train", 2, 7)], "split string, shard_id int, n_tokens long")
    micro = spark.createDataFrame([(s, m) for s in range(4) for m in range(2)], "step long, micro long")
    rows = batches.batch_schedule(micro, lens, 1, 5, 2).collect()
    got = {(r["step"], r["micro"]): (r["cycle"], r["shard_id"], r["batch_idx"]) for r in rows}
    order = [(1, 0), (1, 1), (2, 0)]
    assert got == {(n // 2, n % 2): (n // 3, *order[n % 3]) for n in range(8)}


def test_schedule_joins_no_row_per_batch(spark, monkeypatch):
    """Uneven shards; what is joined stays the same when every shard holds a thousand times as many batches."""
    rng = random.Random(4)
    sizes = [rng.choice([6, 11, 40, 400]) for _ in range(30)]
    micro = spark.createDataFrame([(s, m) for s in range(300) for m in range(2)], "step long, micro long")

    def run(factor):
        lens = spark.createDataFrame([("train", i, (n - 1) * factor + 1) for i, n in enumerate(sizes)], "split string, shard_id int, n_tokens long")
        df = batches.batch_schedule(micro, lens, 1, 5, 2)
        order = [(i, k) for i, n in enumerate(sizes) for k in range(max(1, (n - 1) * factor // 5))]
        got = {(r.step, r.micro): (r.cycle, r.shard_id, r.batch_idx) for r in df.collect()}
        assert got == {(n // 2, n % 2): (n // len(order), *order[n % len(order)]) for n in range(600)}

    joined = []
    real = batches.join_bounded

    def counted(left, small, on):
        joined.append((left.count(), small.count()))
        return real(left, small, on)

    monkeypatch.setattr(batches, "join_bounded", counted)
    run(1)
    run(1000)
    assert all(rows == 600 and stretches <= 3 * len(sizes) for rows, stretches in joined)
    assert batches.batch_schedule(micro, spark.createDataFrame([], "split string, shard_id int, n_tokens long"), 1, 5, 2).count() == 0
