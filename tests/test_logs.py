import math

import pytest
from pyspark.sql import functions as F

from mergeloom.operators import evals, runlogs
from mergeloom.sources import runlogs as files


def test_best_validation_ignores_nan_and_keeps_the_first(spark):
    rows = [("r", 0, 2.0), ("r", 1, float("nan")), ("r", 2, 1.0), ("r", 3, 1.0), ("n", 0, float("nan"))]
    df = spark.createDataFrame(rows, "run_name string, step long, val_loss double")
    got = runlogs.best_validation(df).collect()
    assert [(r["run_name"], r["best_val_loss"], r["best_val_step"]) for r in got] == [("r", 1.0, 2)]
    so_far = {(r["run_name"], r["step"]): r["best_so_far"] for r in runlogs.best_so_far(df).collect()}
    assert so_far == {("r", 0): 2.0, ("r", 1): 2.0, ("r", 2): 1.0, ("r", 3): 1.0, ("n", 0): None}


def test_learning_rate(spark):
    df = spark.range(0, 15).select(
        "id",
        runlogs.learning_rate(F.col("id"), F.lit(1.0), F.lit(0.1), F.lit(4), F.lit(10)).alias("lr"),
    )
    for r in df.collect():
        s = r["id"]
        if s < 4:
            want = (s + 1) / 4
        elif s > 10:
            want = 0.1
        else:
            want = 0.1 + 0.5 * (1 + math.cos(math.pi * (s - 4) / 6)) * 0.9
        assert r["lr"] == pytest.approx(want, abs=1e-12)


def test_schedule_parameters(spark):
    df = spark.createDataFrame(
        [(4, 256, 100, 10_000_000, 1_000_000, 6e-6, 0.5), (4, 1024, 524288, 10**10, 375_000_000, 6e-4, 0.1)],
        "batch_size long, block_size long, total_batch_size long, max_tokens long, warmup_tokens long, max_lr double, min_lr_ratio double",
    )
    bad, good = sorted(runlogs.schedule_parameters(df).collect(), key=lambda r: r["total_batch_size"])
    assert (bad["divisible"], bad["grad_accum"], bad["max_steps"]) == (False, 0, 100_000)
    assert (good["divisible"], good["grad_accum"], good["max_steps"], good["warmup_steps"]) == (True, 128, 19073, 715)


def test_time_accounting_and_triggers(spark):
    paused = [1.0, 0.0, 4.0, 0.0, 0.0, 2.0, 0.0]
    wall = [0.0, 3.0, 5.0, 15.0, 35.0, 36.0, 50.0]
    rows = [("r", i, w, p) for i, (w, p) in enumerate(zip(wall, paused))]
    df = spark.createDataFrame(rows, "run_name string, step long, wall double, paused double")
    timed = runlogs.training_elapsed(df, "wall", "paused").cache()
    got = [r["training_elapsed"] for r in timed.orderBy("step").collect()]
    elapsed = [w - sum(paused[:i]) for i, w in enumerate(wall)]
    assert got == elapsed
    fired, due = [], 10
    for i, e in enumerate(elapsed):
        if e >= due:
            fired.append(i)
            while due <= e:
                due += 10
    assert sorted(r["step"] for r in runlogs.periodic_validations(timed, 10.0).collect()) == fired
    kept = [r["step"] for r in runlogs.steps_before_stop(timed, 30.0).collect()]
    assert sorted(kept) == [i for i in range(7) if i < next(j for j, e in enumerate(elapsed) if e >= 30)]


def test_summary_and_final_validation(spark):
    log = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 2.0), ("b", 0, 1.0)], "run_name string, step long, elapsed_seconds double")
    val = spark.createDataFrame([("a", 0, 3.0), ("b", 0, 2.0)], "run_name string, step long, val_loss double")
    configs = spark.createDataFrame([("a", 2), ("b", 9)], "run_name string, max_steps long")
    rows = {r["run_name"]: r for r in runlogs.run_summary(log, val, configs).collect()}
    assert not rows["a"]["stopped_due_to_time"] and rows["b"]["stopped_due_to_time"]
    assert rows["a"]["elapsed_seconds"] == 2.0 and rows["a"]["best_val_step"] == 0
    final = runlogs.final_validations(log, val).collect()
    assert [(r["run_name"], r["step"], r["last_val_step"]) for r in final] == [("a", 1, 0)]


def test_config_grid_last_wins(spark):
    rows = [(i, n, i) for i, n in enumerate(["c1", "c2", "c3", "c1"])]
    got = runlogs.last_config_wins(spark.createDataFrame(rows, "ord int, run_name string, n_layer int"))
    assert [(r["run_name"], r["n_layer"]) for r in got.orderBy("position").collect()] == [("c1", 3), ("c2", 1), ("c3", 2)]


def test_losses(spark):
    rows = [("r", 0, i, float(i)) for i in range(25)]
    df = spark.createDataFrame(rows, "run_name string, step long, batch_idx long, loss double")
    assert runlogs.validation_loss(df).first()["val_loss"] == sum(range(20)) / 20
    assert runlogs.accumulated_loss(df, 25).first()["train_loss"] == pytest.approx(12.0)
    assert runlogs.rank_average(df).first()["loss"] == 12.0


def test_text_log_append_and_scan(spark, tmp_path):
    path = str(tmp_path / "log")
    for kind, value in (("train", 3.14159), ("val", 2.5), ("hella", 0.25)):
        df = spark.createDataFrame([("run a", 250, kind, value)], "run_name string, step long, kind string, value double")
        files.append_text_logs(runlogs.text_log_lines(df), path)
    got = files.read_text_logs(spark, path).collect()
    assert sorted((r["step"], r["kind"], r["value"]) for r in got) == [
        (250, "hella", 0.25), (250, "train", 3.1416), (250, "val", 2.5),
    ]


def test_csv_log_scan_from_run_folders(spark, tmp_path):
    run = tmp_path / "runs" / "layers1"
    run.mkdir(parents=True)
    names = [f.split()[0] for f in files.VAL_LOG_SCHEMA.split(", ")]
    (run / "val_logs.csv").write_text(",".join(names) + "\n250,3.5,33.1,10.0,12.0,2.0,2.0,1.5,,,,,,\n")
    row = files.read_csv_logs(spark, str(tmp_path / "runs" / "*" / "val_logs.csv"), files.VAL_LOG_SCHEMA).first()
    assert (row["run_name"], row["step"], row["val_loss"], row["gpu_power_watts"]) == ("layers1", 250, 3.5, None)


def test_masked_loss_shift_and_ties(spark):
    rows = []
    for cand, losses in enumerate([[1.0, 2.0, 3.0, 9.0], [5.0, 2.0, 3.0, 9.0], [0.5, 9.0, 9.0, 9.0]]):
        for pos, (loss, mask) in enumerate(zip(losses, [0, 0, 1, 1])):
            rows.append((1, cand, pos, loss, mask))
    df = spark.createDataFrame(rows, "example_id long, cand_id int, pos int, loss double, mask int")
    cands = evals.masked_loss(evals.shift_mask(df))
    means = {r["cand_id"]: r["avg_loss"] for r in cands.collect()}
    assert means == {0: 2.5, 1: 2.5, 2: 9.0}  # the mask moves one position left
    assert evals.predictions(cands).first()["pred"] == 0


def test_candidate_without_mask_never_wins(spark):
    df = spark.createDataFrame([(1, 0, 1.0, 0), (1, 1, 5.0, 1)], "example_id long, cand_id int, loss double, mask int")
    preds = evals.predictions(evals.masked_loss(df)).withColumn("label", F.lit(1))
    row = evals.accuracy(preds).first()
    assert (row["num_correct"], row["num_total"], row["acc"]) == (1, 1, 1.0)


def test_position_loss_and_softmax_are_stable(spark):
    logits = [1000.0, 1001.0, 999.0]
    rows = [(0, i, x, 1) for i, x in enumerate(logits)]
    df = spark.createDataFrame(rows, "pos long, cand long, logit double, target long")
    mass = sum(math.exp(x - 1001) for x in logits)
    assert evals.position_loss(df, ["pos"]).first()["loss"] == pytest.approx(math.log(mass))
    probs = {r["cand"]: r["prob"] for r in evals.softmax(df, "pos", "logit").collect()}
    assert probs[1] == pytest.approx(1 / mass) and sum(probs.values()) == pytest.approx(1)


def test_weighted_draw_follows_the_weights(spark):
    base = spark.range(20_000).withColumnRenamed("id", "row_id")
    opts = F.explode(F.array(*[F.struct(F.lit(c).alias("cand"), F.lit(p).alias("prob")) for c, p in ((0, 0.5), (1, 0.3), (2, 0.2), (3, 0.0))]))
    df = base.select("row_id", opts.alias("o")).select("row_id", "o.*")
    drawn = evals.weighted_draw(df, "row_id", "cand", "prob", seed=1, k=2).cache()
    share = {r["cand"]: r["count"] / 20_000 for r in drawn.groupBy("cand").count().collect()}
    assert set(share) == {0, 1} and share[0] == pytest.approx(0.625, abs=0.015)
    again = evals.weighted_draw(df, "row_id", "cand", "prob", seed=1, k=2)
    assert again.exceptAll(drawn).count() == 0
    other = evals.weighted_draw(df, "row_id", "cand", "prob", seed=2, k=2)
    assert other.exceptAll(drawn).count() > 0


def test_config_table(spark):
    from mergeloom.sources.configs import config_grid

    entries = [("comp1", {"n_layer": 2}), ("comp2", {"n_head": 8}), ("comp1", {"n_layer": 8, "total_batch_size": 4096})]
    grid = runlogs.last_config_wins(config_grid(spark, entries))
    rows = {r["run_name"]: r for r in runlogs.schedule_parameters(grid).collect()}
    assert len(rows) == 2 and rows["comp1"]["n_layer"] == 8 and rows["comp1"]["position"] == 0
    assert rows["comp1"]["divisible"] and not rows["comp2"]["divisible"]
    assert rows["comp1"]["grad_accum"] == 4 and rows["comp2"]["max_steps"] == 100_000
    with pytest.raises(ValueError):
        config_grid(spark, [("x", {"layers": 1})])


def test_eval_rows_scan(spark, tmp_path):
    from mergeloom.sources.evals import EVAL_SCHEMA, read_eval_rows

    path = str(tmp_path / "evals")
    rows = [(1, c, p, float(c + p), int(p > 0), 0) for c in range(4) for p in range(3)]
    spark.createDataFrame(rows, EVAL_SCHEMA).write.parquet(path)
    scored = evals.masked_loss(evals.shift_mask(read_eval_rows(spark, path)), extra=[])
    assert evals.predictions(scored).first()["pred"] == 0
    ranked = spark.createDataFrame([(0, 0, 0), (1, 1, 0), (0, 1, 1)], "rank int, pred int, label int")
    by_rank = {r["rank"]: (r["num_correct"], r["num_total"]) for r in evals.accuracy(ranked, ["rank"]).collect()}
    assert by_rank == {0: (2, 2), 1: (0, 1)}


NAMES = ["lr 1e-3:a", "100%", "a+b", "größe é", "x=y", "%20"]


@pytest.mark.parametrize("name", NAMES)
def test_run_names_come_back_as_given(spark, tmp_path, name):
    df = spark.createDataFrame([(name, 250, "val", 2.5)], "run_name string, step long, kind string, value double")
    path = str(tmp_path / "log")
    files.append_text_logs(runlogs.text_log_lines(df), path)
    assert [r["run_name"] for r in files.read_text_logs(spark, path).collect()] == [name]
    own = tmp_path / "runs" / name
    own.mkdir(parents=True)
    (own / "log.txt").write_text("1 val 2.0\n")
    assert [r["run_name"] for r in files.read_text_logs(spark, str(tmp_path / "runs")).collect()] == [name]


def test_blank_and_cut_lines_are_kept_apart(spark, tmp_path):
    run = tmp_path / "r"
    run.mkdir()
    (run / "log.txt").write_text("0 val 3.5\n\n250 tra\nx val 1.0\n250 val\n500 val 2.5")
    lines = files.read_log_lines(spark, str(tmp_path))
    assert sorted(r["step"] for r in files.parse_text_log(lines).collect()) == [0, 500]
    assert sorted(r["value"] for r in files.unreadable_lines(lines).collect()) == ["", "250 tra", "250 val", "x val 1.0"]


def test_csv_kinds_side_by_side(spark, tmp_path):
    run = tmp_path / "runs" / "r 1"
    run.mkdir(parents=True)
    for file, schema, row in (("train", files.TRAIN_LOG_SCHEMA, "1,3.5,0.1"), ("val", files.VAL_LOG_SCHEMA, "250,9.5,99.0")):
        names = [f.split()[0] for f in schema.split(", ")]
        (run / f"{file}_logs.csv").write_text(",".join(names) + "\n" + row + "," * (len(names) - 3) + "\n")
    path = str(tmp_path / "runs")
    train = files.read_csv_logs(spark, path, files=files_of("train")).collect()
    val = files.read_csv_logs(spark, path, files.VAL_LOG_SCHEMA, files_of("val")).collect()
    assert [(r["run_name"], r["train_loss"], r["lr"]) for r in train] == [("r 1", 3.5, 0.1)]
    assert [(r["run_name"], r["val_loss"], r["val_perplexity"]) for r in val] == [("r 1", 9.5, 99.0)]
    with pytest.raises(Exception):  # not by position
        files.read_csv_logs(spark, path, files=files_of("val")).collect()


def files_of(kind):
    return f"{kind}_logs*.csv"


def test_log_mass_on_wide_and_hot_keys(spark):
    rows = [(0, float(x)) for x in range(-600, 600, 7)] + [(1, 5.0)] * 50 + [(2, -1e6), (2, -1e6 - 1)]
    df = spark.createDataFrame(rows, "k long, logit double")
    for r in evals.log_mass(df, ["k"], "logit").collect():
        own = [x for k, x in rows if k == r["k"]]
        assert r["peak"] == max(own) and r["mass"] == pytest.approx(sum(math.exp(x - max(own)) for x in own))


def test_join_back_splits_a_hot_key(spark):
    from mergeloom.operators.joins import join_back

    rows = spark.range(1000).selectExpr("if(id % 3 = 0, 0, id) as k", "id")
    totals = rows.groupBy("k").count()
    got = join_back(rows, totals, "k")
    assert got.count() == 1000 and {r["count"] for r in got.filter("k = 0").collect()} == {334}


def test_summary_keeps_config_columns(spark):
    log = spark.createDataFrame([("a", 0, 1.0)], "run_name string, step long, elapsed_seconds double")
    val = spark.createDataFrame([("a", 0, 3.0)], "run_name string, step long, val_loss double")
    configs = spark.createDataFrame([("a", 2, 6)], "run_name string, max_steps long, n_layer int")
    row = runlogs.run_summary(log, val, configs).first()
    assert (row["n_layer"], row["max_steps"], row["best_val_loss"]) == (6, 2, 3.0)


def test_schedule_without_shards(spark):
    from mergeloom.operators import batches

    micro = spark.createDataFrame([(0, 0)], "step long, micro long")
    lengths = spark.createDataFrame([], "split string, shard_id int, n_tokens long")
    assert batches.batch_schedule(micro, lengths, 2, 4, 1).count() == 0
