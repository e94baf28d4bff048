"""Token statistics and the tokenizer comparison report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.text import DOC_SEPARATOR, byte_length, word_count
from ..session import cut_lineage
from ..sources.corpus import joined_dictionary
from .codec import checked_text, decode_column, encode_chunks
from .dictionary import chunk_dictionary, corpus_position, nested_position
from .tokenizer import FIRST_MERGE_ID, Tokenizer

_KEYS = ["sample", "tokenizer"]


def token_counts(dictionary: DataFrame, tokenizers: list[Tokenizer]) -> DataFrame:
    """(sample, tokenizer, id, cnt, first) from a per-sample chunk dictionary.

    Distinct chunks are encoded once and weighted by their count, so the cost
    follows the number of distinct chunks, not of tokens. `first` is the first
    corpus position (doc, chunk, token) for tie-breaking.
    """
    return coded_counts(encode_chunks(dictionary, tokenizers))


def coded_counts(coded: DataFrame) -> DataFrame:
    """`token_counts` from encoded chunks."""
    tokens = coded.select(
        *_KEYS, "cnt", "first_doc", "first_idx", F.posexplode("tokens").alias("pos", "id")
    )
    # One number per place: its minimum is a hash aggregate, without sorting the tokens.
    place = nested_position(corpus_position(F.col("first_doc"), F.col("first_idx")), F.col("pos"))
    return tokens.groupBy(*_KEYS, "id").agg(
        F.sum("cnt").alias("cnt"), F.min(place).alias("first")
    )


def document_token_counts(coded: DataFrame) -> DataFrame:
    """The same table from encoded documents (sample, tokenizer, doc_id, tokens),
    for encoders that do not work chunk by chunk."""
    tokens = coded.select(*_KEYS, "doc_id", F.posexplode("tokens").alias("pos", "id"))
    return tokens.groupBy(*_KEYS, "id").agg(
        F.count(F.lit(1)).alias("cnt"), F.min(corpus_position(F.col("doc_id"), F.col("pos"))).alias("first")
    )


def top_tokens(counts: DataFrame, n: int = 20) -> DataFrame:
    """(sample, tokenizer, place, id, cnt): the n most frequent tokens, ties to
    the one seen first. Groups are at most a vocabulary in size, and the rank
    filter is applied before the shuffle as well."""
    order = W.partitionBy(*_KEYS).orderBy(F.desc("cnt"), F.asc("first"))
    ranked = counts.withColumn("place", F.row_number().over(order))
    return ranked.filter(F.col("place") <= n).select(*_KEYS, "place", "id", "cnt")


def sample_totals(samples: DataFrame, joined: bool = False) -> DataFrame:
    """(sample, bytes, words); separators between documents count as bytes if they are `joined`,
    and part no words that weren't apart."""
    between = (F.count("text") - 1) * len(DOC_SEPARATOR) if joined else F.lit(0)
    return samples.groupBy("sample").agg(
        (F.sum(byte_length("text")) + between).alias("bytes"), F.sum(word_count("text")).alias("words")
    )


def count_metrics(counts: DataFrame) -> DataFrame:
    """(sample, tokenizer, tokens, unique_tokens, entropy, top_cnt, byte_cnt)."""
    total = counts.groupBy(*_KEYS).agg(F.sum("cnt").alias("tokens"))
    share = F.col("cnt") / F.col("tokens")
    # Both sides are vocabulary-sized; totals are one row per pair.
    return (
        counts.join(total, _KEYS)
        .groupBy(*_KEYS)
        .agg(
            F.max("tokens").alias("tokens"),
            F.count(F.lit(1)).alias("unique_tokens"),
            (-F.sum(share * F.log2(share))).alias("entropy"),
            F.max("cnt").alias("top_cnt"),
            F.sum(F.when(F.col("id") < FIRST_MERGE_ID, F.col("cnt")).otherwise(0)).alias("byte_cnt"),
        )
    )


# Registers of a distinct-count sketch as a power of two, and a bound its relative error
# stays under in all but one of many thousand cases (four standard errors of 0.83 / sqrt(2^14)).
SKETCH_LOG2 = 14
SKETCH_ERROR = 0.026


def distinct_sketches(coded: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., sketch) of the distinct ids in `tokens`: HyperLogLog registers, at
    most 16 kB a row whatever the number of tokens, combined on the map side."""
    ids = coded.select(*keys, F.explode("tokens").alias("id"))
    return ids.groupBy(*keys).agg(F.hll_sketch_agg("id", F.lit(SKETCH_LOG2)).alias("sketch"))


def merged_sketches(sketches: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Sketches of any batches of one key as one: as if taken over all their tokens."""
    return sketches.groupBy(*(keys or _KEYS)).agg(F.hll_union_agg("sketch").alias("sketch"))


def add_sketches(coded: DataFrame, path: str, keys: list[str] | None = None) -> None:
    """Append a batch's sketches to the table at `path`; its tokens need never be read again."""
    distinct_sketches(coded, keys or _KEYS).write.mode("append").parquet(path)


def estimated_distinct(sketches: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(keys..., unique_estimate) over all batches of stored sketches."""
    rows = merged_sketches(sketches, keys)
    return rows.select(*(keys or _KEYS), F.hll_sketch_estimate("sketch").alias("unique_estimate"))


def _ratio(top: Column, bottom: Column) -> Column:
    """0 where the denominator is 0."""
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def report_from_counts(
    counts: DataFrame,
    totals: DataFrame,
    sizes: dict[str, int | None],
    top_n: int = 20,
    checks: DataFrame | None = None,
) -> DataFrame:
    """The wide report, one row per (sample, tokenizer).

    `sizes` maps tokenizer to vocabulary size, `checks` is an optional (sample,
    tokenizer, roundtrip). Empty samples give NULL compression figures.
    """
    best = top_tokens(counts, top_n).groupBy(*_KEYS).agg(
        F.sum("cnt").alias("top_n_cnt"),
        F.transform(
            F.array_sort(F.collect_list(F.struct("place", "id", "cnt"))),
            lambda x: F.struct(x["id"].alias("id"), x["cnt"].alias("cnt")),
        ).alias("top_tokens"),
    )
    every = with_tokenizers(totals, sizes)
    joined = every.join(count_metrics(counts), _KEYS, "left").join(best, _KEYS, "left")
    if checks is not None:
        joined = joined.join(checks, _KEYS, "left")
    else:
        joined = joined.withColumn("roundtrip", F.lit(None).cast("boolean"))
    tokens = F.coalesce("tokens", F.lit(0))
    unique = F.coalesce("unique_tokens", F.lit(0))
    byte_cnt = F.coalesce("byte_cnt", F.lit(0))
    entropy = F.coalesce("entropy", F.lit(0.0)) + F.lit(0.0)
    return joined.select(
        "sample",
        "tokenizer",
        "bytes",
        "words",
        tokens.alias("tokens"),
        F.try_divide(F.col("bytes"), tokens).alias("compression_ratio"),
        (1 - F.try_divide(tokens, F.col("bytes"))).alias("compression_pct"),
        _ratio(F.col("bytes"), tokens).alias("bytes_per_token"),
        _ratio(tokens, F.col("words")).alias("tokens_per_word"),
        _ratio(tokens, F.col("bytes") / 1024).alias("tokens_per_kb"),
        unique.alias("unique_tokens"),
        "vocab_size",
        F.try_divide(unique, F.col("vocab_size")).alias("vocab_coverage"),
        entropy.alias("entropy_bits_per_token"),
        F.when(entropy == 0, 0.0).otherwise(F.pow(F.lit(2.0), entropy)).alias("effective_vocab_size"),
        F.when(tokens == 0, 0.0).otherwise(1 - F.try_divide(unique, tokens)).alias("token_reuse_rate"),
        _ratio(F.col("top_cnt"), tokens).alias("most_common_token_share"),
        _ratio(F.col("top_n_cnt"), tokens).alias(f"top_{top_n}_token_share"),
        _ratio(byte_cnt, tokens).alias("byte_token_share"),
        _ratio(tokens - byte_cnt, tokens).alias("merge_token_share"),
        "top_tokens",
        "roundtrip",
    )


def tokenizer_sizes(tokenizers: list[Tokenizer]) -> dict[str, int | None]:
    return {t.name: len(t.vocab) for t in tokenizers}


def with_tokenizers(samples: DataFrame, sizes: dict[str, int | None]) -> DataFrame:
    """Every sample row once per tokenizer, with its vocabulary size."""
    entries = [
        F.struct(F.lit(name).alias("tokenizer"), F.lit(n).cast("bigint").alias("vocab_size"))
        for name, n in sizes.items()
    ]
    return samples.select("*", F.explode(F.array(*entries)).alias("_t")).select(*samples.columns, "_t.*")


def compare_tokenizers(
    samples: DataFrame,
    tokenizers: list[Tokenizer],
    top_n: int = 20,
    check_roundtrip: bool = False,
    joined: bool = True,
) -> DataFrame:
    """Report over samples (sample, doc_id, text) for tokenizers that share
    nothing but their inputs. Each split pattern needs one pass over the text.

    With `joined`, the documents of a sample count as one text joined by the
    document separator.
    """
    by_pattern: dict[str, list[Tokenizer]] = {}
    for t in tokenizers:
        by_pattern.setdefault(t.pattern, []).append(t)
        samples = samples.withColumn("text", checked_text(F.col("text"), t, "none_raise"))
    counts = checks = totals = None
    for pattern, group in by_pattern.items():
        chunked = joined_dictionary(samples, pattern, "sample") if joined else chunk_dictionary(samples, pattern, ["sample"])
        coded = encode_chunks(chunked, group)
        if check_roundtrip:
            coded = cut_lineage(coded, "coded-chunks")
            part = chunk_roundtrip(coded, group)
            checks = part if checks is None else checks.unionByName(part)
        part = coded_counts(coded)
        counts = part if counts is None else counts.unionByName(part)
        totals = sample_totals(samples, joined) if totals is None else totals
    # Vocabulary-sized and read three times below: the text is tokenized once.
    counts = cut_lineage(counts, "token-counts")
    return report_from_counts(counts, totals, tokenizer_sizes(tokenizers), top_n, checks)


def chunk_roundtrip(coded: DataFrame, tokenizers: list[Tokenizer]) -> DataFrame:
    """(sample, tokenizer, roundtrip): whether decoding gives back every chunk, and so every
    text, from encoded chunks (sample, tokenizer, chunk, tokens)."""
    same = F.lit(None).cast("boolean")
    for t in tokenizers:
        same = F.when(F.col("tokenizer") == t.name, decode_column(t) == F.col("chunk")).otherwise(same)
    return coded.groupBy(*_KEYS).agg(F.bool_and(same).alias("roundtrip"))


def compare_encoders(
    samples: DataFrame, encoders: dict, sizes: dict[str, int | None], top_n: int = 20, decoders: dict | None = None
) -> DataFrame:
    """Report for any named `Column -> Column` encoders over separate texts.

    `roundtrip` tells whether the named decoder, a `Column -> Column` too, gives every text
    back; it is NULL for encoders without one. Texts are encoded once: tokens are stored, and counts and
    round trips read from there.
    """
    coded = checks = None
    for name, encoder in encoders.items():
        part = samples.select("sample", F.lit(name).alias("tokenizer"), "doc_id", "text", encoder(F.col("text")).alias("tokens"))
        if name in (decoders or {}):
            part = cut_lineage(part, "encoded-texts")
            same = F.coalesce(decoders[name](F.col("tokens")) == F.col("text"), F.col("text").isNull())
            check = part.groupBy(*_KEYS).agg(F.bool_and(same).alias("roundtrip"))
            checks = check if checks is None else checks.unionByName(check)
        part = part.drop("text")
        coded = part if coded is None else coded.unionByName(part)
    sizes = {name: sizes.get(name) for name in encoders}
    return report_from_counts(document_token_counts(coded), sample_totals(samples), sizes, top_n, checks)
