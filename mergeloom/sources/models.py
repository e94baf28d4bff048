"""Tokenizer model files and vocabulary listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .paths import plain_path
from ..functions.codes import render_token
from ..operators.tokenizer import FIRST_MERGE_ID, Tokenizer, merges_table, specials_table, vocab_table

# Fixed value: first line of the text model format.
MODEL_HEADER = "minbpe v1"
_HEADER_LINES = 3


def model_lines(spark: SparkSession, tokenizer: Tokenizer) -> DataFrame:
    """(line_no, value) of the text model: header, pattern, specials, merges."""
    head = [MODEL_HEADER, tokenizer.pattern, str(len(tokenizer.specials))]
    head += [f"{token} {i}" for token, i in tokenizer.specials.items()]
    lines = spark.createDataFrame(list(enumerate(head)), "line_no int, value string")
    merges = merges_table(spark, [tokenizer]).select(
        (F.col("rank") + len(head)).alias("line_no"), F.concat_ws(" ", "left", "right").alias("value")
    )
    return lines.unionByName(merges)


def save_model(spark: SparkSession, tokenizer: Tokenizer, directory: str) -> None:
    """Write `<directory>/<name>.model` as a one-file text table (a vocabulary's
    worth of lines) and the typed tables as Parquet beside it."""
    lines = model_lines(spark, tokenizer)
    base = f"{directory}/{tokenizer.name}"
    lines.coalesce(1).sortWithinPartitions("line_no").select("value").write.text(f"{base}.model")
    merges_table(spark, [tokenizer]).write.parquet(f"{base}.merges")
    specials_table(spark, [tokenizer]).write.parquet(f"{base}.specials")


def read_model_lines(spark: SparkSession, path: str) -> DataFrame:
    """(tokenizer, line_no, value) of every model under a path or glob.

    A model is read as one row, whole, so line numbers never depend on how
    files are split; the name is the stem of the `.model` file or folder.
    """
    files = spark.read.text(path, wholetext=True)
    source = plain_path(F.col("_metadata.file_path"))
    name = F.regexp_extract(source, r"([^/]+)\.model(?:/[^/]*)?$", 1)
    lines = files.select(
        name.alias("tokenizer"), F.posexplode(F.split("value", "\r?\n")).alias("line_no", "value")
    )
    return lines.filter(F.col("value") != "")


def parse_models(lines: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(heads, specials, merges) tables; merge ids follow file order from 256.

    heads: (tokenizer, version, pattern, n_specials).
    """
    head = lines.filter(F.col("line_no") < _HEADER_LINES).groupBy("tokenizer").agg(
        F.max(F.when(F.col("line_no") == 0, F.trim("value"))).alias("version"),
        F.max(F.when(F.col("line_no") == 1, F.trim("value"))).alias("pattern"),
        F.max(F.when(F.col("line_no") == 2, F.trim("value").cast("int"))).alias("n_specials"),
    )
    version = F.when(F.col("version") == MODEL_HEADER, F.col("version")).otherwise(
        F.raise_error(F.concat(F.lit("not a tokenizer model: "), F.coalesce("version", F.lit(""))))
    )
    head = head.withColumn("version", version)
    # One head row per model.
    body = lines.filter(F.col("line_no") >= _HEADER_LINES).join(head, "tokenizer")
    at = F.col("line_no") - _HEADER_LINES
    fields = F.split(F.trim("value"), r"\s+")
    specials = body.filter(at < F.col("n_specials")).select(
        "tokenizer", at.alias("ord"), fields[0].alias("token"), fields[1].cast("int").alias("id")
    )
    rank = (at - F.col("n_specials")).cast("int")
    merges = body.filter(at >= F.col("n_specials")).select(
        "tokenizer",
        rank.alias("rank"),
        fields[0].cast("int").alias("left"),
        fields[1].cast("int").alias("right"),
        (rank + FIRST_MERGE_ID).alias("id"),
    )
    return head, specials, merges


def load_models(spark: SparkSession, path: str) -> list[Tokenizer]:
    """Every model under a path or glob such as `dir/*.model`, by name."""
    head, specials, merges = parse_models(read_model_lines(spark, path))
    by_rank: dict[str, list] = {}
    for r in merges.orderBy("tokenizer", "rank").collect():
        by_rank.setdefault(r["tokenizer"], []).append((r["left"], r["right"]))
    by_ord: dict[str, dict] = {}
    for r in specials.orderBy("tokenizer", "ord").collect():
        by_ord.setdefault(r["tokenizer"], {})[r["token"]] = r["id"]
    return [
        Tokenizer(
            h["tokenizer"], tuple(by_rank.get(h["tokenizer"], ())), h["pattern"],
            by_ord.get(h["tokenizer"], {}),
        )
        for h in head.orderBy("tokenizer").collect()
    ]


def vocab_listing(spark: SparkSession, tokenizers: list[Tokenizer]) -> DataFrame:
    """(tokenizer, id, line): `[a][b] -> [ab] id` for merges, `[t] id` else."""
    vocab = vocab_table(spark, tokenizers)
    shown = vocab.select("tokenizer", "id", render_token(F.col("bytes")).alias("s"), "left", "right")
    leaf = shown.select("tokenizer", "id", "s")
    left = leaf.toDF("tokenizer", "left", "s0")
    right = leaf.toDF("tokenizer", "right", "s1")
    joined = shown.join(left, ["tokenizer", "left"], "left").join(right, ["tokenizer", "right"], "left")
    merged = F.format_string("[%s][%s] -> [%s] %d", "s0", "s1", "s", "id")
    line = F.when(F.col("left").isNotNull(), merged).otherwise(F.format_string("[%s] %d", "s", "id"))
    return joined.select("tokenizer", "id", line.alias("line"))


def save_vocab(spark: SparkSession, tokenizer: Tokenizer, directory: str) -> None:
    listing = vocab_listing(spark, [tokenizer])
    # Ids sort like the vocabulary's own order unless a special's id is low.
    listing.coalesce(1).sortWithinPartitions("id").select("line").write.text(
        f"{directory}/{tokenizer.name}.vocab"
    )
