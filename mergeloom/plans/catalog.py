"""Registered queries: one per operator, each over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import codes, text as tx
from ..operators import batches, codec, dictionary, evals, packing, report, runlogs
from ..operators.bpe_train import Training, best_pairs, pair_counts, train, training_state
from ..operators.joins import join_back
from ..operators.prefix import dense_index, range_bounds, range_index
from ..operators.quota import quota_split
from ..operators.tokenizer import Tokenizer, merges_table, specials_table, vocab_table
from ..session import cut_lineage, freed_shuffles, new_path, scratch
from ..sources import corpus, models, runlogs as log_files, shards
from ..sources.evals import read_eval_rows
from ..streaming import streams
from . import derived
from .comparison import train_and_report, train_and_save

# Enough merges for nested tokens and for a rewrite of the training state.
MERGES = 72
FEW = 32
BIG, SMALL = f"regex_vocab_{256 + MERGES}", f"regex_vocab_{256 + FEW}"
FIRST_ROLE = 400
ROLES = {"<|user|>": FIRST_ROLE, "<|assistant|>": FIRST_ROLE + 1, "<|system|>": FIRST_ROLE + 2}
EOT = 256 + MERGES
SHARD = 100_000
B, T, WORLD = 4, 256, 2
USER_PATTERN = r"\p{L}+|\p{N}+|[^\p{L}\p{N}]+"

# Small metadata and stored tables shared by the queries of one application.
_shared: dict[tuple, object] = {}


def _once(spark: SparkSession, sf: str, name: str, make):
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _shared:
        _shared[key] = make()
    return _shared[key]


def docs(spark, sf) -> DataFrame:
    return corpus.scan_corpus(spark, sf)


def joined_docs(spark, sf) -> DataFrame:
    return corpus.with_separators(docs(spark, sf))


def training(spark, sf) -> Training:
    def make():
        # Merges and counts are kept, none of the tables that they are read from.
        with scratch(spark), freed_shuffles(spark):
            return train(corpus.joined_dictionary(docs(spark, sf)), 256 + MERGES, BIG)

    return _once(spark, sf, "training", make)


def tokenizer(spark, sf) -> Tokenizer:
    return training(spark, sf).tokenizer


def tokenizers(spark, sf) -> list[Tokenizer]:
    return [tokenizer(spark, sf), tokenizer(spark, sf).prefix(256 + FEW, SMALL)]


def token_docs(spark, sf) -> DataFrame:
    return _once(
        spark, sf, "token-docs",
        lambda: cut_lineage(codec.token_documents(docs(spark, sf), tokenizer(spark, sf), EOT), "token-docs"),
    )


def shard_path(spark, sf) -> str:
    def make():
        path = new_path(spark, "shards")
        shards.write_shards(packing.pack_shards(token_docs(spark, sf), SHARD), path)
        return path

    return _once(spark, sf, "shards", make)


def shard_pieces(spark, sf) -> DataFrame:
    return shards.read_shards(spark, shard_path(spark, sf))


def by_language(spark, sf) -> DataFrame:
    rows = corpus.spread(corpus.table(spark, sf, "documents").select("doc_id", "lang", "text"))
    return corpus.named_samples(rows, F.col("lang"))


def token_counts(spark, sf) -> DataFrame:
    return report.token_counts(corpus.joined_dictionary(by_language(spark, sf), group="sample"), tokenizers(spark, sf))


def train_log(spark, sf) -> DataFrame:
    return _once(spark, sf, "train-log", lambda: cut_lineage(derived.train_log(spark, sf), "train-log"))


def val_log(spark, sf) -> DataFrame:
    return derived.val_log(train_log(spark, sf))


def digest(tokens: Column | str) -> Column:
    return F.md5(F.array_join(tokens, " ").cast("binary"))


def hex_bytes(column: str = "bytes") -> Column:
    return F.hex(column)


# ---- scans and sinks -------------------------------------------------------

def s1_corpus_scan(spark, sf):
    return docs(spark, sf)


def s2_corpus_slice(spark, sf):
    return corpus.first_documents(docs(spark, sf), 2)


def s3_whole_file_samples(spark, sf):
    path = new_path(spark, "samples")
    rows = corpus.table(spark, sf, "conversations").select("conv_id", "turn", "text")
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn")
    ordered.select("conv_id", F.col("text").alias("value")).write.partitionBy("conv_id").text(path)
    files = corpus.whole_file_samples(spark, path, corpus.parent_folder("conv_id"))
    return files.select("sample", tx.byte_length("text").alias("bytes"), tx.word_count("text").alias("words"))


def s4_named_samples(spark, sf):
    items = corpus.table(spark, sf, "benchmark").select("item_id", "text")
    both = by_language(spark, sf).unionByName(corpus.numbered_samples(items, "item_id"))
    return corpus.corpus_totals(both, "sample")


def s5_shard_scan(spark, sf):
    pieces = shard_pieces(spark, sf).filter(F.col("split") == "train")
    return pieces.select("shard_id", "start", "doc_id", digest("tokens").alias("digest"))


def _saved_models(spark, sf) -> str:
    def make():
        path = new_path(spark, "models")
        for t in tokenizers(spark, sf):
            models.save_model(spark, t.with_specials({"<|endoftext|>": EOT}), path)
        return path

    return _once(spark, sf, "models", make)


def s6_model_import(spark, sf):
    lines = models.read_model_lines(spark, _saved_models(spark, sf) + "/*.model")
    return models.parse_models(lines)[2]


def s7_model_discovery(spark, sf):
    lines = models.read_model_lines(spark, _saved_models(spark, sf) + "/*.model")
    head, _, merges = models.parse_models(lines)
    sizes = merges.groupBy("tokenizer").agg(F.count(F.lit(1)).alias("n_merges"))
    return head.join(sizes, "tokenizer").select("tokenizer", "n_specials", "n_merges")


def _text_log_path(spark, sf) -> str:
    def make():
        path = new_path(spark, "text-logs")
        train_rows = train_log(spark, sf).select(
            "run_name", "step", F.lit("train").alias("kind"), F.col("train_loss").alias("value")
        )
        val_rows = val_log(spark, sf).select(
            "run_name", "step", F.lit("val").alias("kind"), F.col("val_loss").alias("value")
        )
        for rows in (train_rows, val_rows):
            log_files.append_text_logs(runlogs.text_log_lines(rows), path)
        return path

    return _once(spark, sf, "text-logs", make)


def s8_text_log_scan(spark, sf):
    return log_files.read_text_logs(spark, _text_log_path(spark, sf))


def s9_csv_log_scan(spark, sf):
    path = new_path(spark, "csv-logs")
    rows = train_log(spark, sf)
    empty = [
        F.lit(None).cast("double").alias(f.split()[0])
        for f in log_files.TRAIN_LOG_SCHEMA.split(", ")
        if f.split()[0] not in ("step", "train_loss", "elapsed_seconds")
    ]
    wide = rows.select("*", *empty)
    order = [f.split()[0] for f in log_files.TRAIN_LOG_SCHEMA.split(", ")]
    log_files.append_csv_logs(wide.select("run_name", *order), path)
    return log_files.read_csv_logs(spark, path).select("run_name", "step", "train_loss", "elapsed_seconds")


ODD_NAME = " lr 1e-3:a+b%é"


def s9_val_log_scan(spark, sf):
    """Validation logs of runs whose names need escaping in a path."""
    path = new_path(spark, "csv-val-logs")
    rows = val_log(spark, sf).withColumn("run_name", F.concat("run_name", F.lit(ODD_NAME)))
    order = [f.split()[0] for f in log_files.VAL_LOG_SCHEMA.split(", ")]
    empty = {c: F.lit(None).cast("double") for c in order if c not in rows.columns}
    log_files.append_csv_logs(rows.withColumns(empty).select("run_name", *order), path)
    back = log_files.read_csv_logs(spark, path, log_files.VAL_LOG_SCHEMA)
    return back.select("run_name", "step", "val_loss", "elapsed_seconds")


def s10_eval_reader(spark, sf):
    path = new_path(spark, "evals")
    rows = derived.eval_positions(spark, sf).withColumn("label", F.col("example_id") % 4)
    rows.select("example_id", "cand_id", F.col("pos").cast("int"), "loss", "mask", F.col("label").cast("int")).write.parquet(path)
    return read_eval_rows(spark, path)


def s10_eval_scan(spark, sf):
    return derived.eval_loss(spark, sf)


def s11_config_table(spark, sf):
    grid = derived.run_configs(spark, sf)
    return runlogs.last_config_wins(grid).select(
        "position", "run_name", "n_layer", "block_size", "total_batch_size", "max_tokens"
    )


def k1_shard_write(spark, sf):
    pieces = shard_pieces(spark, sf)
    names = shards.list_shards(pieces)
    return shards.read_manifest(spark, shard_path(spark, sf)).join(names, ["split", "shard_id"])


def k2_model_save(spark, sf):
    _saved_models(spark, sf)
    lines = models.read_model_lines(spark, _saved_models(spark, sf) + f"/{BIG}.model")
    return lines.select("line_no", "value")


def k3_vocab_listing(spark, sf):
    return models.vocab_listing(spark, [tokenizer(spark, sf)]).select("id", "line")


def k3_vocab_file(spark, sf):
    path = new_path(spark, "vocab")
    models.save_vocab(spark, tokenizer(spark, sf), path)
    return spark.read.text(f"{path}/{BIG}.vocab").select(F.col("value").alias("line"))


def k4_report_sink(spark, sf):
    path = new_path(spark, "report")
    full = report.compare_tokenizers(by_language(spark, sf), tokenizers(spark, sf))
    full.write.json(path)
    return spark.read.schema(full.schema).json(path).select(
        "sample", "tokenizer", "bytes", "words", "tokens", "unique_tokens"
    )


def k5_log_sinks(spark, sf):
    lines = log_files.read_text_logs(spark, _text_log_path(spark, sf))
    return lines.groupBy("run_name", "kind").agg(
        F.count(F.lit(1)).alias("n"), F.max("step").cast("bigint").alias("last_step")
    )


def k6_train_sizes(spark, sf):
    return merges_table(spark, tokenizers(spark, sf))


def k6_train_and_save(spark, sf):
    """Both sizes trained in one go, written as model files and read back."""
    path = new_path(spark, "trained")
    train_and_save(docs(spark, sf), [256 + FEW, 256 + MERGES], path)
    return merges_table(spark, models.load_models(spark, f"{path}/*.model"))


# ---- projections and predicates --------------------------------------------

def p1_byte_length(spark, sf):
    return docs(spark, sf).select("doc_id", tx.byte_length("text").alias("bytes"))


def p2_word_count(spark, sf):
    return docs(spark, sf).select("doc_id", tx.word_count("text").alias("words"))


def p3_token_range(spark, sf):
    return token_docs(spark, sf).agg(
        F.count(F.lit(1)).alias("docs"),
        F.sum("n_tokens").alias("tokens"),
        F.sum(codec.out_of_range("tokens")).alias("bad"),
    )


def p4_special_presence(spark, sf):
    chat = derived.chat_text(spark, sf)
    found = F.regexp_extract("text", "(" + tx.special_alternation(ROLES) + ")", 1)
    return chat.select("conv_id", "turn", found.alias("token")).filter(F.col("token") != "")


def p5_special_subset(spark, sf):
    chat = derived.chat_text(spark, sf)
    tok = tokenizer(spark, sf).with_specials(ROLES)
    parts = None
    for name, allowed in (("all", "all"), ("none", "none"), ("user", {"<|user|>"})):
        coded = codec.encode_documents(chat, tok, allowed)
        special = F.size(F.filter("tokens", lambda t: t >= FIRST_ROLE)).cast("bigint")
        part = coded.agg(
            F.sum(special).alias("specials"), F.sum(F.size("tokens").cast("bigint")).alias("tokens")
        ).withColumn("mode", F.lit(name))
        parts = part if parts is None else parts.unionByName(part)
    return parts


def p6_split_label(spark, sf):
    ids = shard_pieces(spark, sf).select("shard_id").distinct()
    return ids.select("shard_id", packing.split_label("shard_id").alias("label"))


def p7_eot_prefix(spark, sf):
    coded = token_docs(spark, sf)
    return coded.select("doc_id", F.get("tokens", F.lit(0)).alias("first_token"), "n_tokens")


def p8_round_robin(spark, sf):
    indexed = dense_index(docs(spark, sf).select("doc_id"), "doc_id", "i")
    return batches.round_robin(indexed, "i", 4).select("doc_id", "rank")


def p9_cadence(spark, sf):
    marked = runlogs.with_last_step(train_log(spark, sf))
    step, last = F.col("step"), F.col("last_step")
    return marked.select(
        "run_name", "step",
        runlogs.is_validation_step(step, last).alias("validates"),
        runlogs.is_checkpoint_step(step, last).alias("checkpoints"),
    ).filter("validates or checkpoints")


def p10_schedule(spark, sf):
    cols = ["ord", "min_lr", "warmup_steps", "max_steps", "grad_accum", "divisible"]
    return runlogs.schedule_parameters(derived.run_configs(spark, sf)).select(*cols)


def p11_learning_rate(spark, sf):
    rate = runlogs.learning_rate(
        F.col("step"), F.col("max_lr"), F.col("min_lr"), F.col("warmup_steps"), F.col("max_steps")
    )
    schedule = runlogs.schedule_parameters(derived.log_configs(spark, sf))
    runs = train_log(spark, sf).select("run_name", "step").join(schedule, "run_name")
    return runs.select("run_name", "step", F.round(rate, 12).alias("lr"))


def p12_perplexity(spark, sf):
    value = runlogs.perplexity(F.col("val_loss"))
    return val_log(spark, sf).select("run_name", "step", F.format_string("%.8e", value).alias("ppl"))


def p13_throughput(spark, sf):
    log = train_log(spark, sf)
    lit = lambda n: F.lit(n).cast("double")
    rate = runlogs.throughput(lit(B), lit(T), lit(8), lit(1), F.col("train_loss"))
    return log.select("run_name", "step", F.round(rate, 6).alias("tps"))


# ---- string and array work --------------------------------------------------

def _chunk_digest(spark, sf, pattern):
    parts = tx.chunks("text", pattern)
    rows = docs(spark, sf).select("doc_id", parts.alias("c"))
    return rows.select(
        "doc_id", F.size("c").cast("bigint").alias("n_chunks"),
        F.md5(F.array_join("c", "|").cast("binary")).alias("digest"),
    )


def t1_pretokenize(spark, sf):
    return _chunk_digest(spark, sf, tx.GPT4_PATTERN)


def t2_pretokenize_gpt2(spark, sf):
    return _chunk_digest(spark, sf, tx.GPT2_PATTERN)


def t3_pretokenize_user(spark, sf):
    return _chunk_digest(spark, sf, USER_PATTERN)


def t4_byte_ids(spark, sf):
    ids = codes.code_ids(codes.byte_codes("text"))
    return docs(spark, sf).select("doc_id", digest(ids).alias("digest"))


def t5_merge_pair(spark, sf):
    merged = codes.apply_merges(codes.byte_codes("text"), [(108, 108)])
    return docs(spark, sf).select("doc_id", F.length(merged).cast("bigint").alias("n_tokens"))


def t6_split_specials(spark, sf):
    chat = derived.chat_text(spark, sf)
    parts = tx.split_keeping_specials(F.col("text"), list(ROLES))
    flat = F.flatten(F.transform(parts, lambda p: F.array(p["part"], p["special"])))
    rows = chat.select("conv_id", "turn", F.posexplode(flat).alias("part_idx", "part"))
    return rows.filter(F.col("part").isNotNull())


def t7_lossy_decode(spark, sf):
    cut = F.expr("substring(encode(text, 'UTF-8'), 2)")
    shown = codes.lossy_text(cut)
    return docs(spark, sf).select(
        "doc_id", F.length(shown).cast("bigint").alias("n_chars"), F.md5(shown.cast("binary")).alias("digest")
    )


def t8_escape_controls(spark, sf):
    shown = codes.escape_controls(F.col("text"))
    return docs(spark, sf).select("doc_id", F.md5(shown.cast("binary")).alias("digest"))


def t9_render_token(spark, sf):
    vocab = vocab_table(spark, [tokenizer(spark, sf)])
    return vocab.select("id", codes.render_token(F.col("bytes")).alias("shown"))


def t10_vocab_bytes(spark, sf):
    return vocab_table(spark, [tokenizer(spark, sf)]).select("id", hex_bytes().alias("bytes"))


def t11_slice_concat(spark, sf):
    pieces = shard_pieces(spark, sf)
    ordered = F.array_sort(F.collect_list(F.struct("shard_id", "start", "tokens")))
    whole = pieces.groupBy("doc_id").agg(
        F.flatten(F.transform(ordered, lambda p: p["tokens"])).alias("tokens"),
        F.count(F.lit(1)).alias("n_pieces"),
    )
    return whole.select("doc_id", "n_pieces", digest("tokens").alias("digest"))


def _batches(spark, sf):
    pieces = shard_pieces(spark, sf)
    return batches.batch_rows(pieces, packing.shard_lengths(pieces), B, T, WORLD)


def t12_shift_by_one(spark, sf):
    return _batches(spark, sf).select(
        "shard_id", "batch_idx", "rank", "row", digest("x").alias("x"), digest("y").alias("y")
    )


def t13_reshape(spark, sf):
    return _batches(spark, sf).groupBy("shard_id", "batch_idx", "rank").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.size("x").cast("bigint")).alias("n_tokens")
    )


# ---- encode and decode --------------------------------------------------------

def e1_encode_chunks(spark, sf):
    rows = dictionary.chunk_dictionary(joined_docs(spark, sf)).select("chunk")
    coded = codec.encode_chunks(rows, [tokenizer(spark, sf)])
    return coded.select("chunk", F.array_join("tokens", " ").alias("ids"))


def _coded(df, *keys):
    return df.select(*keys, F.size("tokens").cast("bigint").alias("n_tokens"), digest("tokens").alias("digest"))


def e2_encode_documents(spark, sf):
    return _coded(codec.encode_documents(docs(spark, sf), tokenizer(spark, sf)), "doc_id")


def e3_encode_specials(spark, sf):
    tok = tokenizer(spark, sf).with_specials(ROLES)
    return _coded(codec.encode_documents(derived.chat_text(spark, sf), tok, "all"), "conv_id", "turn")


def e4_decode(spark, sf):
    coded = codec.encode_documents(docs(spark, sf), tokenizer(spark, sf))
    return coded.select("doc_id", F.md5(codec.decode_column(tokenizer(spark, sf)).cast("binary")).alias("digest"))


def e5_roundtrip(spark, sf):
    return codec.roundtrip(docs(spark, sf), tokenizer(spark, sf))


def e6_token_documents(spark, sf):
    return _coded(token_docs(spark, sf), "doc_id")


# ---- aggregations ---------------------------------------------------------------

def _byte_pairs(rows: DataFrame) -> DataFrame:
    weighted = rows.select(codes.byte_codes("chunk").alias("code"), "cnt")
    counted = dictionary.exploded_pairs(weighted).groupBy("pair").agg(F.sum("cnt").alias("cnt"))
    char = lambda i: codes.char_to_id(F.substring("pair", i, 1))
    return counted.select(char(1).alias("left"), char(2).alias("right"), "cnt")


def a1_pair_counts(spark, sf):
    return _byte_pairs(dictionary.chunk_dictionary(joined_docs(spark, sf)))


def a2_incremental_counts(spark, sf):
    items = corpus.table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    first = _byte_pairs(dictionary.chunk_dictionary(docs(spark, sf)))
    more = _byte_pairs(dictionary.chunk_dictionary(items))
    return dictionary.add_counts(first, more, ["left", "right"])


def a3_best_pair(spark, sf):
    state = training_state(dictionary.chunk_dictionary(joined_docs(spark, sf)))
    return best_pairs(pair_counts(state), 1).select("left", "right", "cnt")


def a4_chunk_dictionary(spark, sf):
    return corpus.joined_dictionary(docs(spark, sf))


def a5_bpe_train(spark, sf):
    return training(spark, sf).trace(spark).select("rank", "left", "right", "id")


def a6_token_frequency(spark, sf):
    return token_counts(spark, sf).select("sample", "tokenizer", "id", "cnt")


def _report(spark, sf):
    return report.compare_tokenizers(by_language(spark, sf), tokenizers(spark, sf), check_roundtrip=True)


def a7_tokenizer_report(spark, sf):
    ratios = [
        "compression_ratio", "compression_pct", "bytes_per_token", "tokens_per_word", "tokens_per_kb",
        "vocab_coverage", "entropy_bits_per_token", "effective_vocab_size", "token_reuse_rate",
        "most_common_token_share", "top_20_token_share", "byte_token_share", "merge_token_share",
    ]
    return _report(spark, sf).select(
        "sample", "tokenizer", "bytes", "words", "tokens", "unique_tokens", "vocab_size",
        *[F.round(c, 6).alias(c) for c in ratios], "roundtrip",
    )


def a8_top_tokens(spark, sf):
    return report.top_tokens(token_counts(spark, sf), 20)


def a9_entropy(spark, sf):
    rows = report.count_metrics(token_counts(spark, sf))
    return rows.select("sample", "tokenizer", F.round("entropy", 6).alias("entropy"))


def a10_distinct_tokens(spark, sf):
    return report.count_metrics(token_counts(spark, sf)).select("sample", "tokenizer", "tokens", "unique_tokens")


def a10_distinct_sketch(spark, sf):
    """Sketches of every source, stored one after the other and merged by language,
    against the exact count."""
    rows = corpus.spread(corpus.table(spark, sf, "documents").select("doc_id", F.col("lang").alias("sample"), "source", "text"))
    coded = cut_lineage(codec.encode_documents(rows, tokenizer(spark, sf)).withColumn("tokenizer", F.lit(BIG)), "coded")
    path, keys = new_path(spark, "sketches"), ["sample", "tokenizer"]
    report.add_sketches(coded.where("doc_id % 2 = 0"), path, [*keys, "source"])
    report.add_sketches(coded.where("doc_id % 2 <> 0"), path, [*keys, "source"])
    stored = spark.read.schema("sample string, tokenizer string, source string, sketch binary").parquet(path)
    exact = coded.select(*keys, F.explode("tokens").alias("id")).groupBy(*keys).agg(F.count_distinct("id").alias("unique_tokens"))
    error = F.abs(F.col("unique_estimate") - F.col("unique_tokens")) / F.col("unique_tokens")
    return exact.join(report.estimated_distinct(stored), keys).select(
        *keys, "unique_tokens", (error <= report.SKETCH_ERROR).alias("within_bound")
    )


def a11_byte_tokens(spark, sf):
    rows = report.count_metrics(token_counts(spark, sf))
    return rows.select("sample", "tokenizer", "byte_cnt", (F.col("tokens") - F.col("byte_cnt")).alias("merge_cnt"))


def a12_validation_loss(spark, sf):
    rows = derived.micro_loss(train_log(spark, sf), 32).withColumnRenamed("micro", "batch_idx")
    return runlogs.validation_loss(rows).withColumn("val_loss", F.round("val_loss", 6))


def a13_accumulated_loss(spark, sf):
    rows = runlogs.accumulated_loss(derived.micro_loss(train_log(spark, sf)), 8)
    return rows.withColumn("train_loss", F.round("train_loss", 6))


def a14_best_validation(spark, sf):
    return runlogs.best_validation(val_log(spark, sf))


def _schedules(spark, sf):
    """Schedules of the logged runs."""
    return runlogs.schedule_parameters(derived.log_configs(spark, sf)).select(
        "run_name", "max_steps", "warmup_steps", "max_lr", "min_lr"
    )


def a15_run_summary(spark, sf):
    return runlogs.run_summary(train_log(spark, sf), val_log(spark, sf), _schedules(spark, sf))


def _candidates(spark, sf):
    return evals.masked_loss(derived.eval_loss(spark, sf), "loss_cents", ["label"])


def a16_masked_loss(spark, sf):
    return _candidates(spark, sf).select("example_id", "cand_id", "loss_sum", "mask_sum")


def a17_predictions(spark, sf):
    return evals.predictions(_candidates(spark, sf))


def a16_shifted_mask(spark, sf):
    """Each position's loss counts under the mask of the next one."""
    aligned = evals.shift_mask(derived.eval_positions(spark, sf))
    scored = evals.masked_loss(aligned)
    return scored.select("example_id", "cand_id", F.col("loss_sum").cast("bigint").alias("loss_sum"), "mask_sum")


def _scored(spark, sf):
    return evals.predictions(_candidates(spark, sf), ["label"])


def a18_accuracy(spark, sf):
    rows = evals.accuracy(_scored(spark, sf))
    return rows.select("num_correct", "num_total", F.round("acc", 9).alias("acc"))


def a19_rank_average(spark, sf):
    return runlogs.rank_average(derived.micro_loss(train_log(spark, sf))).withColumn("loss", F.round("loss", 6))


def a20_corpus_totals(spark, sf):
    return corpus.corpus_totals(quota_split(docs(spark, sf)), "split")


def a21_joined_text(spark, sf):
    path = new_path(spark, "joined")
    corpus.export_joined(quota_split(docs(spark, sf)), "split", path, 1 << 16)
    return corpus.exported_digests(spark, path).select(F.col("label").alias("split"), "digest")


def a22_training_trace(spark, sf):
    rows = training(spark, sf).trace(spark)
    return rows.select("rank", "left", "right", "id", hex_bytes().alias("bytes"), "cnt")


def a23_position_loss(spark, sf):
    rows = derived.scores(spark, sf)
    target = rows.groupBy("row_id").agg(F.min("cand").alias("target"))
    losses = evals.position_loss(join_back(rows, target, "row_id"), ["row_id"])
    return losses.select("row_id", F.round("loss", 6).alias("loss"))


# ---- joins ------------------------------------------------------------------------

def j1_dictionary_join(spark, sf):
    return _coded(codec.encode_by_dictionary(docs(spark, sf), tokenizer(spark, sf)), "doc_id")


def j2_token_bytes(spark, sf):
    counts = token_docs(spark, sf).select(F.explode("tokens").alias("id")).groupBy("id").agg(
        F.count(F.lit(1)).alias("cnt")
    )
    vocab = vocab_table(spark, [tokenizer(spark, sf)])
    return counts.join(vocab, "id", "left").select("id", "cnt", hex_bytes().alias("bytes"))


def j3_special_join(spark, sf):
    tok = tokenizer(spark, sf).with_specials(ROLES)
    chat = codec.encode_documents(derived.chat_text(spark, sf), tok, "all")
    specials = specials_table(spark, [tok])
    ids = chat.select(F.explode("tokens").alias("id"))
    return ids.join(F.broadcast(specials), "id").groupBy("token", "id").agg(F.count(F.lit(1)).alias("cnt"))


def j4_samples_by_tokenizers(spark, sf):
    texts = corpus.with_separators(by_language(spark, sf), "sample")
    return report.with_tokenizers(
        report.sample_totals(texts), report.tokenizer_sizes(tokenizers(spark, sf))
    )


def j5_vocab_children(spark, sf):
    vocab = vocab_table(spark, [tokenizer(spark, sf)])
    child = vocab.select("id", hex_bytes().alias("hex"))
    left = child.toDF("left", "left_bytes")
    right = child.toDF("right", "right_bytes")
    joined = vocab.join(left, "left", "left").join(right, "right", "left")
    return joined.select("id", "left_bytes", "right_bytes")


def j6_contains_special(spark, sf):
    chat = derived.chat_text(spark, sf)
    some = tx.special_alternation(["<|user|>", "<|system|>"])
    return chat.filter(F.col("text").rlike(some)).select("conv_id", "turn")


def j7_logs_with_config(spark, sf):
    log = train_log(spark, sf).groupBy("run_name").agg(F.max("step").alias("last_step"))
    return log.join(_schedules(spark, sf).select("run_name", "max_steps"), "run_name")


def j8_document_shards(spark, sf):
    narrow = token_docs(spark, sf).select("doc_id", "n_tokens")
    return packing.shard_spans(packing.document_offsets(narrow), SHARD)


def j9_prediction_label(spark, sf):
    return _scored(spark, sf).select("example_id", "pred", "label", (F.col("pred") == F.col("label")).alias("hit"))


# ---- ordered operators ---------------------------------------------------------------

def w1_quota_split(spark, sf):
    return quota_split(docs(spark, sf)).select("doc_id", "split")


def w2_document_offsets(spark, sf):
    narrow = token_docs(spark, sf).select("doc_id", "n_tokens")
    return packing.document_offsets(narrow)


def w3_pack_shards(spark, sf):
    rows = packing.pack_shards(token_docs(spark, sf), SHARD)
    return rows.select(
        "split", "shard_id", "start", "doc_id", F.size("tokens").cast("bigint").alias("n_tokens"),
        digest("tokens").alias("digest"),
    )


def w4_batch_windows(spark, sf):
    return _batches(spark, sf).select("split", "shard_id", "batch_idx", "rank", "row", digest("x").alias("x"))


def w5_next_tokens(spark, sf):
    rows = packing.next_tokens(shard_pieces(spark, sf))
    labels = F.transform("labels", lambda t: F.coalesce(t, F.lit(-1)))
    return rows.select("shard_id", "start", digest(labels).alias("labels"))


def _timed(spark, sf):
    """Wall time with each step's value taken as its non-training seconds."""
    log = train_log(spark, sf).withColumn("paused", F.col("train_loss"))
    return runlogs.training_elapsed(log, "elapsed_seconds", "paused")


def w6_periodic_validation(spark, sf):
    return runlogs.periodic_validations(train_log(spark, sf), 86_400.0, "elapsed_seconds")


def w7_training_elapsed(spark, sf):
    rows = _timed(spark, sf)
    return rows.select("run_name", "step", F.round("training_elapsed", 6).alias("training_elapsed"))


def w8_best_so_far(spark, sf):
    return runlogs.best_so_far(val_log(spark, sf)).select("run_name", "step", "best_so_far")


def w9_stop_condition(spark, sf):
    rows = runlogs.steps_before_stop(train_log(spark, sf), 500_000.0, "elapsed_seconds")
    return rows.groupBy("run_name").agg(F.count(F.lit(1)).alias("steps"), F.max("step").alias("last_step"))


def w10_final_validation(spark, sf):
    log = train_log(spark, sf)
    return runlogs.final_validations(log, derived.periodic_val_log(log))


def w11_batch_schedule(spark, sf):
    micro = derived.micro_loss(train_log(spark, sf)).select("run_name", "step", "micro")
    lengths = shards.read_manifest(spark, shard_path(spark, sf), "train")
    return batches.batch_schedule(micro, lengths, B, T, 8)


def w12_softmax(spark, sf):
    rows = evals.softmax(derived.scores(spark, sf), "row_id", "logit")
    return rows.select("row_id", "cand", F.round("prob", 9).alias("prob"))


# ---- order, sets, streams, extensions ----------------------------------------------------

def l1_shard_list(spark, sf):
    return shards.list_shards(shard_pieces(spark, sf))


def l2_top_chunks(spark, sf):
    rows = dictionary.chunk_dictionary(joined_docs(spark, sf))
    return rows.orderBy(F.desc("cnt"), "first_doc", "first_idx").limit(20).select("chunk", "cnt")


def l3_arg_extremes(spark, sf):
    rows = train_log(spark, sf)
    low = F.min(F.struct("train_loss", "step"))
    high = F.max(F.struct(F.col("train_loss"), (-F.col("step")).alias("neg")))
    return rows.groupBy("run_name").agg(low.alias("l"), high.alias("h")).select(
        "run_name", F.col("l.step").alias("first_min"), (-F.col("h.neg")).alias("first_max")
    )


def l4_quota_stop(spark, sf):
    return quota_split(docs(spark, sf), 500_000, 250_000).groupBy("split").agg(
        F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc")
    )


def l5_top_candidates(spark, sf):
    rows = derived.probabilities(derived.scores(spark, sf))
    top = evals.top_candidates(rows, "row_id", "cand", "prob", 50)
    return top.select("row_id", "cand", F.col("place").cast("bigint").alias("place"))


def l5_weighted_draw(spark, sf):
    rows = derived.probabilities(derived.scores(spark, sf))
    return evals.weighted_draw(rows, "row_id", "cand", "prob", seed=42)


def u1_disjoint_split(spark, sf):
    parts = quota_split(docs(spark, sf)).select("doc_id", "split")
    side = lambda name: parts.filter(F.col("split") == name).select("doc_id")
    shared = side("train").intersect(side("test"))
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n")
    return count(side("train"), "train").unionByName(count(side("test"), "test")).unionByName(
        count(shared, "both")
    )


def u2_allowed_specials(spark, sf):
    roles = corpus.table(spark, sf, "conversations").select(F.concat(F.lit("<|"), "role", F.lit("|>")).alias("token"))
    registered = specials_table(spark, [tokenizer(spark, sf).with_specials(ROLES)])
    return registered.join(roles.distinct(), "token", "left_semi").select("token", "id")


def u3_union_logs(spark, sf):
    log = train_log(spark, sf)
    evals_log = derived.micro_loss(log, 250).filter(F.col("micro") == 0).select(
        "run_name", F.col("step") * 250, (F.col("loss") / 1000).alias("acc")
    ).toDF("run_name", "step", "acc")
    rows = runlogs.union_logs(log, val_log(spark, sf), evals_log)
    return rows.groupBy("run_name", "kind").agg(
        F.count(F.lit(1)).alias("n"), F.sum("step").alias("steps"),
        F.sum(F.round(F.col("value") * 100_000).cast("bigint")).alias("total"),
    )


def _stream_paths(spark, name):
    return new_path(spark, name), new_path(spark, name + "-checkpoint")


def st1_encode_stream(spark, sf):
    stream = streams.encode_stream(streams.document_stream(spark, sf), tokenizer(spark, sf))
    return _coded(streams.run_to_table(stream, *_stream_paths(spark, "encoded")), "doc_id")


# Bytes of text in a file that arrives, about.
ARRIVING_BYTES = 64 << 20


def _document_files(spark, sf, n=3, file_bytes=ARRIVING_BYTES) -> tuple[str, int]:
    """(path, files): the documents in doc_id order as n arrivals, each later than the one before, of so many files.

    A file is a range of doc_id and one task's work; an arrival has one file until its text exceeds `file_bytes`.
    """
    def make():
        path, rows = new_path(spark, "arriving"), corpus.table(spark, sf, "documents")
        size = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("bigint")), F.lit(0))).first()[0]
        files = max(1, -(-size // (n * file_bytes)))
        bounds = range_bounds(rows.select("doc_id"), "doc_id", n * files)
        part = range_index("doc_id", bounds)
        # Every range but the first one holds its lower bound, and Spark writes the first
        # partition's file even without rows: so every arrival but the last has exactly `files`.
        for first in range(0, max(n, len(bounds) + 1), files):
            own = rows.withColumn("_part", part - first).where(F.col("_part").between(0, files - 1))
            own = own.repartitionById(files, "_part") if files > 1 else own.coalesce(1)
            own.drop("_part").write.mode("append").parquet(path)
        return path, files

    return _once(spark, sf, "document-files", make)


def _arriving(spark, sf) -> DataFrame:
    """The documents as a stream, an arrival a micro-batch."""
    path, files = _document_files(spark, sf)
    return streams.document_stream(spark, path, "part-", files)


def st2_token_count_stream(spark, sf):
    arriving = _arriving(spark, sf)
    counts = streams.token_count_stream(streams.encode_stream(arriving, tokenizer(spark, sf)))
    path, checkpoint = _stream_paths(spark, "counts")
    return streams.CountTable(path, ["id"], "id int, cnt bigint", 2).run(counts, checkpoint)


def st2_pair_count_stream(spark, sf):
    arriving = _arriving(spark, sf)
    counts = streams.pair_count_stream(streams.chunk_stream(arriving))
    path, checkpoint = _stream_paths(spark, "pair-counts")
    table = streams.CountTable(path, ["left", "right"], "left int, right int, cnt bigint")
    return table.run(counts, checkpoint)


def st3_run_metrics_stream(spark, sf):
    log = streams.text_log_stream(spark, _text_log_path(spark, sf))
    live = streams.run_metrics_stream(log)
    return streams.run_to_table(live, *_stream_paths(spark, "metrics"), mode="complete")


def st4_shard_fill_stream(spark, sf):
    arriving = _arriving(spark, sf)
    coded = codec.token_documents(arriving, tokenizer(spark, sf), EOT)
    path, checkpoint = _stream_paths(spark, "fill")
    pieces = streams.ShardFill(path, SHARD).run(coded, checkpoint)
    return pieces.select("split", "shard_id", "start", "doc_id", digest("tokens").alias("digest"))


def f1_custom_pattern(spark, sf):
    rows = dictionary.chunk_dictionary(docs(spark, sf), USER_PATTERN)
    return rows.select("chunk", "cnt")


def f2_outside_encoder(spark, sf):
    encoder = codec.external_encoder(encode_batch=lambda texts: [s.encode("utf-8") for s in texts])
    decoder = codec.external_decoder(lambda ids: bytes(ids).decode("utf-8"))
    rows = report.compare_encoders(
        by_language(spark, sf), {"raw_bytes": encoder}, {"raw_bytes": 256}, decoders={"raw_bytes": decoder}
    )
    return rows.select(
        "roundtrip",
        "sample", "tokenizer", "bytes", "tokens", "unique_tokens",
        F.round("compression_ratio", 6).alias("compression_ratio"),
    )


def f3_special_vocab(spark, sf):
    tok = tokenizer(spark, sf).with_specials(ROLES)
    vocab = vocab_table(spark, [tok]).filter(F.col("id") >= FIRST_ROLE)
    used = codec.encode_documents(derived.chat_text(spark, sf), tok, "all")
    ids = used.select(F.explode("tokens").alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("cnt"))
    return vocab.join(ids, "id", "left").select("id", F.decode("bytes", "UTF-8").alias("token"), F.coalesce("cnt", F.lit(0)).alias("cnt"))


def train_and_report_query(spark, sf):
    rows = train_and_report(docs(spark, sf), [256 + FEW, 256 + MERGES])
    return rows.select("sample", "tokenizer", "bytes", "words", "tokens", "unique_tokens", "vocab_size")


def registered() -> dict:
    prefixes = ("s", "k", "p", "t", "e", "a", "j", "w", "l", "u", "st", "f")
    found = {}
    for name, fn in globals().items():
        head = name.split("_")[0]
        if head.rstrip("0123456789") in prefixes and head[-1].isdigit() and callable(fn):
            found[name] = fn
    found["train_and_report"] = train_and_report_query
    return found
