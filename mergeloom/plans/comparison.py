"""End-to-end plans composed from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import GPT4_PATTERN
from ..operators.batches import batch_rows
from ..operators.bpe_train import train_sizes
from ..operators.codec import token_documents
from ..operators.packing import pack_shards, shard_lengths
from ..operators.quota import quota_split
from ..operators.report import compare_tokenizers
from ..operators.tokenizer import Tokenizer
from ..session import cut_lineage, new_path
from ..sources.corpus import joined_dictionary
from ..sources.models import load_models, save_model, save_vocab
from ..sources.shards import read_shards, write_shards


def train_and_report(
    docs: DataFrame, vocab_sizes: list[int], train_bytes: int = 100_000, test_bytes: int = 100_000
) -> DataFrame:
    """Train tokenizers of several sizes on the train quota, report on the test
    quota: one training at the largest size, one pass over the test text."""
    parts = quota_split(docs, train_bytes, test_bytes)
    train_docs = parts.filter(F.col("split") == "train").select("doc_id", "text")
    test_docs = parts.filter(F.col("split") == "test").select(
        F.lit("test").alias("sample"), "doc_id", "text"
    )
    tokenizers = train_sizes(joined_dictionary(train_docs), vocab_sizes)
    return compare_tokenizers(test_docs, tokenizers)


def train_and_save(docs: DataFrame, vocab_sizes: list[int], directory: str, pattern: str | None = None) -> list[Tokenizer]:
    """Train several sizes on a corpus and write their model and vocabulary
    files as `regex_vocab_<size>`."""
    made = train_sizes(joined_dictionary(docs, pattern or GPT4_PATTERN), vocab_sizes, pattern)
    for tokenizer in made:
        save_model(docs.sparkSession, tokenizer, directory)
        save_vocab(docs.sparkSession, tokenizer, directory)
    return made


def report_on_models(samples: DataFrame, directory: str, output: str, top_n: int = 20) -> DataFrame:
    """Compare every saved model of a directory on samples (sample, doc_id,
    text); the report is written as JSON lines and read back."""
    spark = samples.sparkSession
    rows = compare_tokenizers(samples, load_models(spark, f"{directory}/*.model"), top_n)
    rows.write.json(output)
    return spark.read.schema(rows.schema).json(output)


def build_shards(docs: DataFrame, tokenizer: Tokenizer, eot: int, shard_size: int) -> DataFrame:
    """Tokenize, pack and write shards; returns the stored pieces."""
    spark = docs.sparkSession
    coded = cut_lineage(token_documents(docs, tokenizer, eot), "token-docs")
    path = new_path(spark, "shards")
    write_shards(pack_shards(coded, shard_size), path)
    return read_shards(spark, path)


def training_batches(pieces: DataFrame, B: int, T: int, world: int = 1) -> DataFrame:
    return batch_rows(pieces, shard_lengths(pieces), B, T, world)
