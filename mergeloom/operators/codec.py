"""Encoding and decoding of document tables.

`encode_documents` is a narrow operator: Spark's regex makes the chunks, each
Arrow batch encodes its distinct chunks once, and no row leaves its partition.
`encode_by_dictionary` is the join form: distinct chunks are encoded once and joined with where they stand. `encode_column` is the pure expression form, for few merges.
"""

from __future__ import annotations

import itertools
import json
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import ragged
from ..functions.codes import apply_merges, byte_codes, code_ids, lossy_text
from ..functions.ragged import (
    SLICE_BYTES, ChunkBlock, IdTable, MergeRanks, binary_rows, byte_lengths, encode_lists, encode_strings, gathered_rows, list_rows, packed_ids,
    read_varints, take_rows, to_list_array, weight_cuts,
)
from ..functions.text import chunks, chunks_with_specials, special_alternation
from ..session import cut_lineage, freed_shuffles
from .joins import join_bounded
from .tokenizer import FIRST_MERGE_ID, Tokenizer

# Executors need not have this package installed: its task code travels along.
cloudpickle.register_pickle_by_value(ragged)

# Fixed value: token files hold unsigned 16-bit ids.
MAX_TOKEN = 1 << 16
# Bytes of text whose documents share a list of chunks, about.
_BLOCK_BYTES = 64 << 20
# Chunks whose ids are packed or handed on at once, and bytes of chunk numbers that are dealt out at once.
_PACK_ROWS = 1 << 18
_DEAL_BYTES = 1 << 18


def _with_field(schema: T.StructType, drop: str, *fields: T.StructField) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name != drop] + list(fields))


_TOKENS = T.StructField("tokens", T.ArrayType(T.IntegerType(), True), True)


def checked_text(text: Column, tokenizer: Tokenizer, allowed_special) -> Column:
    """For "none_raise": fail on text that contains any registered special."""
    if allowed_special != "none_raise" or not tokenizer.specials:
        return text
    found = text.rlike(special_alternation(tokenizer.specials))
    return F.when(
        found, F.raise_error(F.lit("special token in text with allowed_special=none_raise"))
    ).otherwise(text)


def chunk_column(text: Column, tokenizer: Tokenizer, allowed_special="none_raise") -> Column:
    allowed = tokenizer.allowed(allowed_special)
    text = checked_text(text, tokenizer, allowed_special)
    if not allowed:
        return chunks(text, tokenizer.pattern)
    return chunks_with_specials(text, tokenizer.pattern, list(allowed))


def encode_documents(
    docs: DataFrame, tokenizer: Tokenizer, allowed_special="none_raise", text: str = "text"
) -> DataFrame:
    """Replace `text` by `tokens array<int>`; all other columns are kept.

    By default a text that contains a registered special token fails the job;
    "none" encodes it as ordinary text, "all" or a set as special ids.
    """
    allowed = tokenizer.allowed(allowed_special)
    merges = tokenizer.merges
    chunked = docs.withColumn(text, chunk_column(F.col(text), tokenizer, allowed_special))
    schema = _with_field(chunked.schema, text, _TOKENS)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = MergeRanks(merges, FIRST_MERGE_ID)
        for batch in batches:
            for first, tokens in encode_lists(batch.column(text), table, allowed):
                rest = [batch.column(c).slice(first, len(tokens)) for c in schema.names if c != "tokens"]
                yield pa.RecordBatch.from_arrays([*rest, tokens], names=schema.names)

    return chunked.mapInArrow(encode, schema)


def encode_chunks(df: DataFrame, tokenizers: list[Tokenizer], chunk: str = "chunk") -> DataFrame:
    """Add (tokenizer, tokens) to each chunk row, once per tokenizer."""
    tables = [(t.name, t.merges, dict(t.specials)) for t in tokenizers]
    schema = T.StructType(
        df.schema.fields + [T.StructField("tokenizer", T.StringType(), False), _TOKENS]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranked = [(name, MergeRanks(merges, FIRST_MERGE_ID)) for name, merges, _ in tables]
        for batch in batches:
            # Some bytes of chunks at a time: merging holds many times what it reads.
            for a, b in itertools.pairwise(weight_cuts(byte_lengths(batch.column(chunk)), SLICE_BYTES)):
                some = batch.slice(a, b - a)
                for name, table in ranked:
                    tokens = to_list_array(*encode_strings(some.column(chunk), table, {}))
                    label = pa.array([name] * some.num_rows, pa.string())
                    yield pa.RecordBatch.from_arrays([*some.columns, label, tokens], names=schema.names)

    return df.mapInArrow(encode, schema)


def coded_blocks(docs: DataFrame, pattern: str) -> DataFrame:
    """Chunk occurrences of (doc_id, text), the text split once: (block, doc_id, codes, code, chunk).

    A block is some documents that one task reads, about `_BLOCK_BYTES` of text. Its distinct chunks are a row
    each (code, chunk); a document's row has the codes of its chunks in order, as packed numbers.
    """
    doc_id = docs.schema["doc_id"]
    listed = docs.select("doc_id", chunks("text", pattern).alias("chunks"))
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()), T.StructField("doc_id", doc_id.dataType), T.StructField("codes", T.BinaryType()),
            T.StructField("code", T.IntegerType()), T.StructField("chunk", T.StringType()),
        ]
    )

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = TaskContext.get().partitionId() << 32, ChunkBlock()
        for batch in batches:
            ids = batch.column("doc_id")
            # Copied: what is kept of a batch would keep all of it.
            block.add(batch.column("chunks"), ids.take(pa.array(np.arange(len(ids)))))
            if block.bytes >= _BLOCK_BYTES:
                yield from rows(number, block)
                number, block = number + 1, ChunkBlock()
        if block.parts:
            yield from rows(number, block)

    def rows(number: int, block: ChunkBlock) -> Iterator[pa.RecordBatch]:
        found, parts = block.finish()

        def batch(n: int, **own: pa.Array) -> pa.RecordBatch:
            own["block"] = pa.array(np.full(n, number, np.int64))
            return pa.RecordBatch.from_arrays([own[f.name] if f.name in own else pa.nulls(n, kinds[f.name]) for f in schema], names=schema.names)

        kinds = {"doc_id": parts[0][1][0].type, "codes": pa.binary(), "code": pa.int32(), "chunk": pa.string()}
        for a in range(0, len(found), _PACK_ROWS):
            some = found.slice(a, _PACK_ROWS)
            yield batch(len(some), code=pa.array(np.arange(a, a + len(some), dtype=np.int32)), chunk=some)
        for codes, (ids,) in parts:
            for first, some in codes:
                yield batch(len(some), doc_id=ids.slice(first, len(some)), codes=some)

    return listed.mapInArrow(coded, schema)


def _packed(met: DataFrame) -> DataFrame:
    """(block, data): rows (block, code, tokens) in packs of one block, for `IdTable`."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            number, code = (batch.column(c).to_numpy(zero_copy_only=False).copy() for c in ("block", "code"))
            values, lengths = list_rows(batch.column("tokens"))
            held.append((number, code, values.copy(), lengths))
            n += len(number)
            if n >= _PACK_ROWS:
                yield packs(held)
                held, n = [], 0
        if n:
            yield packs(held)

    def packs(held) -> pa.RecordBatch:
        number, code, values, lengths = (np.concatenate(c) for c in zip(*held))
        order = np.lexsort((code, number))
        number, code = number[order], code[order]
        values, lengths = take_rows(values, lengths, order)
        cuts = np.flatnonzero(np.diff(number, prepend=number[0] - 1))
        ends, own = np.r_[0, np.cumsum(lengths)], []
        for a, b in zip(cuts, np.r_[cuts[1:], len(number)]):
            own.append(packed_ids(code[a:b], values[ends[a] : ends[b]], lengths[a:b]))
        return pa.RecordBatch.from_arrays([pa.array(number[cuts]), pa.array(own, pa.binary())], names=["block", "data"])

    return met.select("block", "code", "tokens").mapInArrow(pack, "block bigint, data binary")


def _dealt_out(pieces: DataFrame, packs: DataFrame, by_chunk: bool = False) -> DataFrame:
    """(doc_id, tokens) of documents (block, doc_id, codes) that meet their block's ids; `by_chunk`, a list for each chunk.

    A task has a block's packs before its documents, and passes on some tokens at a time.
    """
    kind = T.ArrayType(_TOKENS.dataType) if by_chunk else _TOKENS.dataType
    schema = T.StructType([pieces.schema["doc_id"], T.StructField("tokens", kind)])
    nothing = F.lit(None).cast(pieces.schema["doc_id"].dataType)
    both = packs.select("block", F.lit(0).alias("kind"), nothing.alias("doc_id"), "data").unionByName(
        pieces.select("block", F.lit(1).alias("kind"), "doc_id", F.col("codes").alias("data"))
    )

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, table = None, IdTable()
        for batch in batches:
            number, kind = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("block", "kind"))
            cuts = np.flatnonzero((np.diff(number, prepend=-1) != 0) | (np.diff(kind, prepend=-1) != 0))
            for a, b in zip(cuts, np.r_[cuts[1:], len(number)]):
                if number[a] != current:
                    current, table = number[a], IdTable()
                raw, sizes = binary_rows(batch.column("data").slice(a, b - a))
                if kind[a]:
                    yield from told(table, raw, sizes, batch.column("doc_id").slice(a, b - a))
                else:
                    for part in np.split(raw, np.cumsum(sizes)[:-1]):
                        table.add(part)

    def told(table: IdTable, raw: np.ndarray, sizes: np.ndarray, ids: pa.Array) -> Iterator[pa.RecordBatch]:
        values, lengths, starts = table.rows()
        ends = np.cumsum(sizes)
        for a, b in itertools.pairwise(weight_cuts(sizes, _DEAL_BYTES)):
            some = raw[ends[a] - sizes[a] : ends[b - 1]]
            codes = read_varints(some)
            # Chunks of a document: its bytes that end a number.
            seen = np.r_[0, np.cumsum(some < 128)]
            last = seen[ends[a:b] - ends[a] + sizes[a]]
            n_chunks = np.diff(last, prepend=0)
            tokens, n_tokens = gathered_rows(values, lengths, codes, starts)
            if by_chunk:
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, last].astype(np.int32)), to_list_array(tokens, n_tokens))
            else:
                lists = to_list_array(tokens, np.diff(np.r_[0, np.cumsum(n_tokens)][last], prepend=0))
            yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), lists], names=schema.names)

    return both.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(deal, schema)


def encode_by_dictionary(docs: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """(doc_id, tokens) by joining chunk occurrences with encoded chunks.

    The text is split once, into stored blocks of documents with their distinct chunks. These, a row a block and
    chunk, are joined with the dictionary, which is broadcast if it is small, so a frequent chunk has no more rows than there are blocks;
    documents move as packed numbers, once, to meet their block's ids.
    Special tokens are ordinary text. Rows of one doc_id share the tokens of all of them in the order of chunk number and ids; a null one has none.
    """
    with freed_shuffles(docs.sparkSession):
        repeated = docs.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        repeated = cut_lineage(repeated, "repeated-documents")
        blocks = cut_lineage(coded_blocks(docs.select("doc_id", "text"), tokenizer.pattern), "chunk-occurrences", "zstd")
        words = blocks.filter(F.col("chunk").isNotNull()).select("block", "code", "chunk")
        coded = encode_chunks(words.select("chunk").distinct(), [tokenizer]).select("chunk", "tokens")
        packs = cut_lineage(_packed(join_bounded(words, coded, "chunk")), "chunk-codes", "zstd")
    pieces = blocks.filter(F.col("codes").isNotNull()).select("block", "doc_id", "codes")
    tokens = F.when(F.col("doc_id").isNull(), F.array().cast("array<int>")).otherwise(F.col("tokens")).alias("tokens")
    if repeated.isEmpty():
        return _dealt_out(pieces, packs).select("doc_id", tokens)
    flagged = join_bounded(pieces, repeated, "doc_id", "left")
    single = _dealt_out(flagged.filter(F.col("n").isNull()), packs).select("doc_id", tokens)
    lists = _dealt_out(flagged.filter(F.col("n").isNotNull()), packs, by_chunk=True)
    placed = F.transform("tokens", lambda ids, i: F.struct(i.alias("chunk_idx"), ids.alias("ids")))
    merged = lists.groupBy("doc_id").agg(
        F.array_sort(F.flatten(F.collect_list(placed))).alias("p"), F.count(F.lit(1)).cast("int").alias("n")
    )
    shared = merged.select("doc_id", "n", F.flatten(F.transform("p", lambda x: x["ids"])).alias("tokens"))
    return single.unionByName(shared.select("doc_id", F.explode(F.array_repeat("tokens", F.col("n"))).alias("tokens")))


def encode_column(tokenizer: Tokenizer, text: Column | str = "text", allowed_special="none_raise") -> Column:
    """`array<int>` of token ids as a built-in expression, no Python worker."""
    text = F.col(text) if isinstance(text, str) else text
    allowed = tokenizer.allowed(allowed_special)

    def ids(chunk: Column) -> Column:
        plain = code_ids(apply_merges(byte_codes(chunk), tokenizer.merges, FIRST_MERGE_ID))
        for token, token_id in allowed.items():
            plain = F.when(chunk == token, F.array(F.lit(token_id))).otherwise(plain)
        return plain

    return F.flatten(F.transform(chunk_column(text, tokenizer, allowed_special), ids))


def decode_column(tokenizer: Tokenizer, tokens: Column | str = "tokens") -> Column:
    """Text of an id array; malformed UTF-8 becomes U+FFFD, unknown ids fail."""
    tokens = F.col(tokens) if isinstance(tokens, str) else tokens
    table = tokenizer.vocab
    dense_size = FIRST_MERGE_ID + len(tokenizer.merges)
    dense = _string_array([table[i].decode("latin-1") for i in range(dense_size)])
    sparse = {i: b.decode("latin-1") for i, b in table.items() if i >= dense_size}

    def piece(token: Column) -> Column:
        known = F.get(dense, token)
        for token_id, raw in sparse.items():
            known = F.when(token == token_id, F.lit(raw)).otherwise(known)
        unknown = F.raise_error(F.concat(F.lit("invalid token id: "), token.cast("string")))
        return F.coalesce(known, unknown.cast("string"))

    return lossy_text(F.encode(F.array_join(F.transform(tokens, piece), ""), "ISO-8859-1"))


def _string_array(values: list[str]) -> Column:
    return F.from_json(F.lit(json.dumps(values)), "array<string>")


def checked_tokens(tokens: Column) -> Column:
    """Fail the job on an id outside 0 <= id < 2^16."""
    bad = (F.array_min(tokens) < 0) | (F.array_max(tokens) >= MAX_TOKEN)
    return F.when(bad, F.raise_error(F.lit("token id does not fit 16 bits"))).otherwise(tokens)


def token_documents(docs: DataFrame, tokenizer: Tokenizer, eot: int) -> DataFrame:
    """(doc_id, tokens, n_tokens): end-of-text id, then the document's tokens."""
    coded = encode_documents(docs.select("doc_id", "text"), tokenizer, "none")
    tokens = checked_tokens(F.concat(F.array(F.lit(eot)), F.col("tokens")))
    return coded.select("doc_id", tokens.alias("tokens")).withColumn("n_tokens", F.size("tokens"))


def roundtrip(docs: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """(doc_id, ok): does decoding the encoding give the text back."""
    coded = encode_documents(docs.select("doc_id", F.col("text").alias("original"), "text"), tokenizer)
    return coded.select("doc_id", (decode_column(tokenizer) == F.col("original")).alias("ok"))


def special_violations(docs: DataFrame, specials: list[str]) -> DataFrame:
    """Documents that contain a special token, with the first one found."""
    hit = F.regexp_extract("text", "(" + special_alternation(specials) + ")", 1)
    return docs.select("doc_id", hit.alias("token")).filter(F.col("token") != "")


def out_of_range(tokens: Column | str) -> Column:
    """Number of ids outside 0 <= id < 2^16."""
    return F.size(F.filter(tokens, lambda t: (t < 0) | (t >= MAX_TOKEN))).cast("bigint")


def external_encoder(encode=None, encode_batch=None):
    """Column encoder for an outside tokenizer: `encode(str) -> list[int]`, or
    `encode_batch(list[str]) -> list[list[int]]` where it has one. NULL stays NULL.

    Texts are handed over some bytes at a time, and their ids are kept as 32-bit values, never as Python lists of a batch.
    """

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def run(texts: pa.Array) -> pa.Array:
        lengths, values = np.zeros(len(texts), np.int64), bytearray()
        missing = texts.is_null().to_numpy(zero_copy_only=False)
        for a, b in itertools.pairwise(weight_cuts(byte_lengths(texts), SLICE_BYTES)):
            at = a + np.flatnonzero(~missing[a:b])
            known = texts.slice(a, b - a).drop_null().to_pylist()
            for i, ids in zip(at, encode_batch(known) if encode_batch else map(encode, known)):
                ids = np.array(list(ids), np.int32)
                lengths[i] = len(ids)
                values += ids.tobytes()
        lists = to_list_array(np.frombuffer(values, np.int32), lengths)
        return pa.ListArray.from_arrays(lists.offsets, lists.values, mask=pa.array(missing))

    return run


def external_decoder(decode):
    """Column decoder for an outside tokenizer's `decode(list[int]) -> str`."""

    @F.arrow_udf(T.StringType())
    def run(tokens: pa.Array) -> pa.Array:
        values, offsets = tokens.values.to_numpy(zero_copy_only=False), tokens.offsets.to_numpy()
        rows = zip(offsets[:-1].tolist(), offsets[1:].tolist(), tokens.is_valid().to_pylist())
        return pa.array([decode(values[a:b].tolist()) if valid else None for a, b, valid in rows], pa.string())

    return run
