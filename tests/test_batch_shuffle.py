from mergeloom.operators import batches


def shuffled(df):
    """Records that the exchanges of a collected query wrote."""
    waiting, total = [df._jdf.queryExecution().executedPlan()], 0
    while waiting:
        node = waiting.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            waiting.append(node.finalPhysicalPlan())
        elif "QueryStage" in node.nodeName():
            waiting.append(node.plan())
        else:
            if node.nodeName() == "Exchange":
                total += node.metrics().apply("shuffleRecordsWritten").value()
            waiting += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_rows_inside_one_piece_are_not_shuffled(spark):
    tokens = list(range(10_000))
    cuts = [0, 4_003, 4_003, 4_005, 10_000]
    pieces = spark.createDataFrame(
        [("train", 1, a, tokens[a:b]) for a, b in zip(cuts, cuts[1:])], "split string, shard_id int, start bigint, tokens array<int>"
    )
    lengths = spark.createDataFrame([("train", 1, 10_000)], "split string, shard_id int, n_tokens bigint")
    rows = batches.batch_rows(pieces, lengths, 1, 10)
    got = {r.batch_idx: (r.x, r.y) for r in rows.collect()}
    assert got == {k: (tokens[10 * k : 10 * k + 10], tokens[10 * k + 1 : 10 * k + 11]) for k in range(999)}
    assert shuffled(rows) < 50
