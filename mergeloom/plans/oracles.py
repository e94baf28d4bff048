"""DuckDB SQL with the same results as the registered queries.

Written independently of the Spark side: RE2 patterns with a marker for the
missing look-ahead, bytes through hex, training as a chain of CTEs.
"""

from __future__ import annotations

from ..functions.text import GPT4_PATTERN
from .catalog import B, BIG, EOT, FEW, FIRST_ROLE, MERGES, ODD_NAME, ROLES, SHARD, SMALL, T, WORLD

_ROLE_RE = "(<\\|user\\|>|<\\|assistant\\|>|<\\|system\\|>)"

# ---- text building blocks ----------------------------------------------------

_GPT4 = (
    r"'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}\x01]?\p{L}+|\p{N}{1,3}"
    r"| ?[^\s\p{L}\p{N}\x01]+[\r\n]*|\s*[\r\n]|\x01?\s+\x01?"
)
_GPT2 = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}\x01]+|\s+"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _gpt4_chunks(text: str) -> str:
    marked = rf"regexp_replace({text}, '([^\S\r\n]+)([^\S\r\n]\S)', '\1'||chr(1)||'\2', 'g')"
    return (
        f"list_transform(regexp_extract_all({marked}, {_q(_GPT4)}), "
        f"lambda x: replace(x, chr(1), ''))"
    )


def _gpt2_chunks(text: str) -> str:
    marked = rf"regexp_replace({text}, '(\s+)(\s\S)', '\1'||chr(1)||'\2', 'g')"
    return f"regexp_extract_all({marked}, {_q(_GPT2)})"


def _code(text: str) -> str:
    """Byte b as chr(256 + b); `text` must be a plain column."""
    return (
        f"array_to_string(list_transform(range(0, octet_length(encode({text}))), "
        f"lambda i: chr(256 + ('0x' || substr(hex(encode({text})), 2*i::INT+1, 2))::INT)), '')"
    )


def _ids(code: str) -> str:
    return (
        f"array_to_string(list_transform(CASE WHEN {code} = '' THEN [] ELSE string_split({code}, '') END, "
        f"lambda x: ord(x) - 256), ' ')"
    )


_JOINED = (
    "joined AS (SELECT doc_id, text || CASE WHEN doc_id = (SELECT max(doc_id) FROM documents) "
    "THEN '' ELSE chr(10) || chr(10) END AS text FROM documents)"
)


def _dictionary(name: str, source: str, key: str = "doc_id", extra: str = "") -> str:
    """CTE `name` (extra, chunk, cnt, d, i) from CTE/table `source`."""
    group = f"{extra}, " if extra else ""
    return f"""{name} AS MATERIALIZED (
      SELECT {group}chunk, count(*)::BIGINT AS cnt, min((d, i)).d AS d, min((d, i)).i AS i FROM (
        SELECT {group}{key} AS d, unnest(c) AS chunk, unnest(range(len(c))) AS i
        FROM (SELECT {group}{key}, {_gpt4_chunks("text")} AS c FROM {source}))
      GROUP BY {group}chunk)""".replace("min((d, i)).d", "min({'d': d, 'i': i}).d").replace(
        "min((d, i)).i", "min({'d': d, 'i': i}).i"
    )


def _training() -> str:
    """CTEs joined, dict, s0..sN (coded states) and p0..pN-1 (winning pairs)."""
    parts = [_JOINED, _dictionary("dict", "joined")]
    parts.append(f"s0 AS MATERIALIZED (SELECT chunk, {_code('chunk')} AS s, cnt, d, i FROM dict)")
    for k in range(MERGES):
        parts.append(f"""p{k} AS MATERIALIZED (
          SELECT pair, sum(cnt)::BIGINT AS n FROM (
            SELECT substr(s, j::INT, 2) AS pair, cnt, d, i, j
            FROM (SELECT s, cnt, d, i, unnest(range(1, length(s))) AS j FROM s{k}))
          GROUP BY pair ORDER BY n DESC, min({{'d': d, 'i': i, 'j': j}}) LIMIT 1)""")
        parts.append(f"""s{k + 1} AS MATERIALIZED (
          SELECT chunk, replace(s, (SELECT pair FROM p{k}), chr({512 + k})) AS s, cnt, d, i FROM s{k})""")
    pairs = " UNION ALL ".join(
        f"SELECT {k} AS rank, pair, n FROM p{k}" for k in range(MERGES)
    )
    parts.append(f"pairs AS MATERIALIZED ({pairs})")
    parts.append(
        "merges AS (SELECT rank, ord(pair[1]) - 256 AS \"left\", ord(pair[2]) - 256 AS \"right\", "
        "256 + rank AS id, n, pair FROM pairs)"
    )
    return ", ".join(parts)


def _apply(code: str, upto: int = MERGES) -> str:
    for k in range(upto):
        code = f"replace({code}, (SELECT pair FROM p{k}), chr({512 + k}))"
    return code


def _encoded(name: str, source: str, keys: str, chunks: str | None = None, upto: int = MERGES) -> str:
    """CTE `name` (keys, code): documents of `source` as merged code strings."""
    chunks = chunks or _gpt4_chunks("text")
    return f"""{name}_o AS MATERIALIZED (
        SELECT {keys}, unnest(c) AS chunk, unnest(range(len(c))) AS ci
        FROM (SELECT {keys}, {chunks} AS c FROM {source})),
      {name}_d AS MATERIALIZED (
        SELECT chunk, {_apply("s", upto)} AS s
        FROM (SELECT chunk, {_code("chunk")} AS s FROM (SELECT DISTINCT chunk FROM {name}_o))),
      {name} AS MATERIALIZED (
        SELECT {keys}, string_agg(s, '' ORDER BY ci) AS code
        FROM {name}_o JOIN {name}_d USING (chunk) GROUP BY {keys})"""


def _with(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


_TRAIN = _training()
_DOCS = _encoded("enc", "documents", "doc_id")
# Token documents as code strings: end-of-text first.
_TOKEN_DOCS = (
    f"tdocs AS MATERIALIZED (SELECT doc_id, chr({256 + EOT}) || code AS code, "
    f"length(code) + 1 AS n FROM enc)"
)
_OFFSETS = (
    "offs AS MATERIALIZED (SELECT doc_id, code, n, "
    "coalesce(sum(n) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS o "
    "FROM tdocs)"
)
_SPANS = f"""spans AS MATERIALIZED (
    SELECT doc_id, sid, greatest(o, sid * {SHARD}) - sid * {SHARD} AS start,
           greatest(o, sid * {SHARD}) - o AS skip,
           least(o + n, (sid + 1) * {SHARD}) - greatest(o, sid * {SHARD}) AS take, code
    FROM (SELECT *, unnest(range(o // {SHARD}, (o + n - 1) // {SHARD} + 1)) AS sid FROM offs))"""
_PIECES = """pieces AS MATERIALIZED (
    SELECT CASE WHEN sid = 0 THEN 'val' ELSE 'train' END AS split, sid::INT AS shard_id, start, doc_id,
           substr(code, (skip + 1)::INT, take::INT) AS code FROM spans)"""
_SHARDS = [_TRAIN, _DOCS, _TOKEN_DOCS, _OFFSETS, _SPANS, _PIECES]
_STREAMS = [
    *_SHARDS,
    "shard_text AS MATERIALIZED (SELECT split, shard_id, string_agg(code, '' ORDER BY start) AS code "
    "FROM pieces GROUP BY split, shard_id)",
]


def _batch_rows() -> list[str]:
    bt = B * T
    served = f"""served AS (
      SELECT split, shard_id, code, r AS rank, unnest(range(0, greatest(1,
        floor((length(code) - 1 - r * {bt}) / {bt * WORLD})::BIGINT))) AS batch_idx
      FROM (SELECT *, unnest(range(0, {WORLD})) AS r FROM shard_text))"""
    rows = f"""brows AS MATERIALIZED (
      SELECT split, shard_id, batch_idx, rank::INT AS rank, row::INT AS row,
             substr(code, (rank * {bt} + batch_idx * {bt * WORLD} + row * {T} + 1)::INT, {T + 1}) AS w
      FROM (SELECT *, unnest(range(0, {B})) AS row FROM served))"""
    return [*_STREAMS, served, rows, f"complete AS (SELECT * FROM brows WHERE length(w) = {T + 1})"]


_CHAT = (
    "chat AS MATERIALIZED (SELECT conv_id, turn, '<|' || role || '|>' || text AS text FROM conversations)"
)
_LOG = """log AS MATERIALIZED (
    SELECT event_type AS run_name, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS step,
           value AS train_loss,
           (epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY event_type)) / 1e6 AS elapsed_seconds
    FROM events)"""
_LAST = "lasts AS (SELECT run_name, max(step) AS last_step FROM log GROUP BY run_name)"
_VAL = """val AS MATERIALIZED (SELECT run_name, step, train_loss AS val_loss, elapsed_seconds
    FROM log JOIN lasts USING (run_name) WHERE step % 250 = 0 OR step = last_step)"""
_LOGS = [_LOG, _LAST, _VAL]
_MICRO = (
    "micro AS (SELECT run_name, step // 8 AS step, step % 8 AS micro, train_loss AS loss FROM log)"
)
_EVAL = """evals AS MATERIALIZED (
    SELECT l_partkey AS example_id, (l_linenumber % 4)::INT AS cand_id,
           round(l_extendedprice * 100)::BIGINT AS loss_cents,
           CASE WHEN l_quantity > 10 THEN 1 ELSE 0 END AS mask, l_partkey % 4 AS label FROM lineitem)"""
_CANDS = """cands AS (SELECT example_id, cand_id, label, sum(loss_cents * mask)::BIGINT AS loss_sum,
    sum(mask)::BIGINT AS mask_sum FROM evals GROUP BY ALL)"""
_PREDS = """preds AS (SELECT example_id, label, arg_min(cand_id, {'a': loss_sum / mask_sum, 'c': cand_id}) AS pred
    FROM cands WHERE mask_sum > 0 GROUP BY example_id, label)"""
_EVALS = [_EVAL, _CANDS, _PREDS]
_CONFIGS = """configs AS (SELECT p_partkey AS ord, p_brand AS run_name, p_size::BIGINT % 8 + 1 AS n_layer,
    4 AS batch_size, 64 * (p_size::BIGINT % 4 + 1) AS block_size, 4096 * (p_size::BIGINT % 3 + 1) AS total_batch_size,
    p_size::BIGINT * 100000 AS max_tokens, p_size::BIGINT * 10000 AS warmup_tokens,
    round(p_retailprice)::BIGINT / 1e6 AS max_lr, 0.5::DOUBLE AS min_lr_ratio FROM part)"""
_LOG_CONFIGS = """log_configs AS (SELECT event_type AS run_name, 20 * count(DISTINCT user_id) AS max_steps,
    count(DISTINCT user_id) AS warmup_steps, 6e-4::DOUBLE AS max_lr, 6e-4::DOUBLE * 0.1::DOUBLE AS min_lr
    FROM events GROUP BY event_type)"""

_QUOTA = """sized AS (SELECT doc_id, octet_length(encode(text)) AS b, text FROM documents),
  summed AS (SELECT *, coalesce(sum(b) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c
    FROM sized),
  quota AS MATERIALIZED (SELECT doc_id, text, b, CASE WHEN c < {train} THEN 'train'
      WHEN c - (SELECT sum(b) FROM summed WHERE c < {train}) < {test} THEN 'test' END AS split FROM summed),
  taken AS (SELECT * FROM quota WHERE split IS NOT NULL)"""
_QUOTA_DEFAULT = _QUOTA.format(train=100_000, test=100_000)

_LANG_JOINED = """lj AS (SELECT lang, doc_id, text || CASE WHEN doc_id = max(doc_id) OVER (PARTITION BY lang)
    THEN '' ELSE chr(10) || chr(10) END AS text FROM documents)"""


def _token_counts() -> list[str]:
    """CTE tc (sample, tokenizer, id, cnt, f) for both vocabularies by language."""
    per = []
    for name, upto in ((BIG, MERGES), (SMALL, FEW)):
        per.append(f"""SELECT lang AS sample, '{name}' AS tokenizer, ord(ch) - 256 AS id, sum(cnt)::BIGINT AS cnt,
          min({{'d': d, 'i': i, 'j': j}}) AS f
          FROM (SELECT lang, cnt, d, i, unnest(string_split(s, '')) AS ch, unnest(range(length(s))) AS j
                FROM (SELECT lang, cnt, d, i, {_apply("s", upto)} AS s FROM lcode))
          GROUP BY lang, ch""")
    return [
        _TRAIN,
        _LANG_JOINED,
        _dictionary("ldict", "lj", extra="lang"),
        f"lcode AS MATERIALIZED (SELECT lang, {_code('chunk')} AS s, cnt, d, i FROM ldict)",
        "tc AS MATERIALIZED (" + " UNION ALL ".join(per) + ")",
        "tt AS MATERIALIZED (SELECT sample, tokenizer, sum(cnt)::BIGINT AS tokens FROM tc GROUP BY ALL)",
        """totals AS MATERIALIZED (SELECT lang AS sample, sum(octet_length(encode(text)))::BIGINT AS bytes,
           sum(len(regexp_extract_all(text, '\\S+')))::BIGINT AS words FROM lj GROUP BY lang)""",
        """ranked AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY sample, tokenizer ORDER BY cnt DESC, f) AS place
           FROM tc)""",
        f"""metrics AS MATERIALIZED (SELECT sample, tokenizer, any_value(tokens) AS tokens, count(*) AS uniq,
           -sum(cnt / tokens * log2(cnt / tokens)) AS entropy, max(cnt) AS top_cnt,
           sum(CASE WHEN place <= 20 THEN cnt ELSE 0 END)::BIGINT AS top_n,
           sum(CASE WHEN id < 256 THEN cnt ELSE 0 END)::BIGINT AS byte_cnt,
           CASE tokenizer WHEN '{BIG}' THEN {256 + MERGES} ELSE {256 + FEW} END AS v
           FROM ranked JOIN tt USING (sample, tokenizer) GROUP BY sample, tokenizer)""",
    ]


def _byte_pairs(name: str, source: str) -> str:
    return f"""{name} AS (SELECT ord(pair[1]) - 256 AS "left", ord(pair[2]) - 256 AS "right", sum(cnt)::BIGINT AS cnt
      FROM (SELECT substr(s, j::INT, 2) AS pair, cnt FROM (
        SELECT s, cnt, unnest(range(1, length(s))) AS j FROM (SELECT {_code('chunk')} AS s, cnt FROM {source})))
      GROUP BY pair)"""


_EXPANDED = "pair"
for _k in reversed(range(MERGES)):
    _EXPANDED = f"replace({_EXPANDED}, chr({512 + _k}), (SELECT pair FROM p{_k}))"
_HEX = "array_to_string(list_transform(string_split(x, ''), lambda c: printf('%02X', ord(c) - 256)), '')"
_VOCAB = (
    "exp AS (SELECT id, \"left\", \"right\", " + _EXPANDED + " AS x FROM merges), "
    "vocab AS MATERIALIZED (SELECT i::INT AS id, NULL::INT AS \"left\", NULL::INT AS \"right\", printf('%02X', i::INT) AS h "
    "FROM range(0, 256) t(i) UNION ALL SELECT id::INT, \"left\"::INT, \"right\"::INT, " + _HEX + " FROM exp)"
)
# Bytes as hex of every id in order, one fold over the pairs.
_SPELLED = (
    "spelled AS (SELECT list_reduce(list_prepend(list_transform(range(0, 256), lambda i: printf('%02X', i::INT)), "
    "(SELECT list([pair[1], pair[2]] ORDER BY rank) FROM pairs)), "
    "lambda a, p: list_append(a, a[ord(p[1]) - 255] || a[ord(p[2]) - 255])) AS h)"
)
# Shown form of a byte string given as hex: broken characters at either end (two-byte
# characters are the longest in these texts) and escapes of control characters.
_BROKEN_START = "regexp_extract(h, '^((?:[89AB][0-9A-F])*)', 1)"
_BROKEN_END = "regexp_extract(h, '^(?:..)*?([C-F][0-9A-F])?$', 1)"
_WHOLE = f"substr(h, length({_BROKEN_START}) + 1, length(h) - length({_BROKEN_START}) - length({_BROKEN_END}))"
_SHOWN = (
    f"repeat(chr(65533), (length({_BROKEN_START}) // 2)::INT) || array_to_string(list_transform(string_split(decode(unhex({_WHOLE})), ''), "
    "lambda c: CASE WHEN c = '' THEN '' WHEN ord(c) < 32 OR ord(c) = 127 THEN '\\u00' || lower(printf('%02X', ord(c))) ELSE c END), '')"
    f" || CASE WHEN {_BROKEN_END} = '' THEN '' ELSE chr(65533) END"
)


def _digest(code: str = "code") -> str:
    return f"md5({_ids(code)})"


def _chunk_digest(chunks: str) -> str:
    return (
        f"SELECT doc_id, len(c)::BIGINT AS n_chunks, md5(array_to_string(c, '|')) AS digest "
        f"FROM (SELECT doc_id, {chunks} AS c FROM documents)"
    )


_CHAT_PARTS = f"""parts AS MATERIALIZED (
    SELECT conv_id, turn, unnest(p) AS part, unnest(range(len(p))) AS pi
    FROM (SELECT conv_id, turn, string_split(regexp_replace(text, {_q(_ROLE_RE)}, chr(2) || '\\1' || chr(2), 'g'), chr(2)) AS p
          FROM chat)),
  pchunks AS MATERIALIZED (
    SELECT conv_id, turn, pi, unnest(c) AS chunk, unnest(range(len(c))) AS ci FROM (
      SELECT conv_id, turn, pi, CASE WHEN part IN ({", ".join(map(_q, ROLES))}) THEN [part]
             ELSE {_gpt4_chunks("part")} END AS c FROM parts)),
  pdict AS MATERIALIZED (SELECT chunk, CASE
      {" ".join(f"WHEN chunk = {_q(t)} THEN chr({256 + i})" for t, i in ROLES.items())}
      ELSE {_apply("s")} END AS s FROM (SELECT chunk, {_code("chunk")} AS s FROM (SELECT DISTINCT chunk FROM pchunks))),
  chat_enc AS MATERIALIZED (SELECT conv_id, turn, string_agg(s, '' ORDER BY pi, ci) AS code
    FROM pchunks JOIN pdict USING (chunk) GROUP BY conv_id, turn)"""


def sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["s1_corpus_scan"] = "SELECT doc_id, text FROM documents"
    q["s2_corpus_slice"] = "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 2"
    q["s3_whole_file_samples"] = r"""SELECT conv_id::VARCHAR AS sample, octet_length(encode(t))::BIGINT AS bytes,
        len(regexp_extract_all(t, '\S+'))::BIGINT AS words
        FROM (SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) || chr(10) AS t FROM conversations GROUP BY conv_id)"""
    q["s4_named_samples"] = """SELECT lang AS sample, count(*) AS docs, sum(octet_length(encode(text)))::BIGINT AS bytes
        FROM documents GROUP BY lang
        UNION ALL SELECT 'sample_' || (row_number() OVER (ORDER BY item_id) - 1), 1, octet_length(encode(text))::BIGINT
        FROM benchmark"""
    q["s5_shard_scan"] = _with(*_SHARDS) + (
        f"SELECT shard_id, start, doc_id, {_digest()} AS digest FROM pieces WHERE split = 'train'"
    )
    both = (
        f"SELECT '{BIG}' AS tokenizer, rank::INT AS rank, \"left\"::INT AS \"left\", \"right\"::INT AS \"right\", id::INT AS id "
        f"FROM merges UNION ALL SELECT '{SMALL}', rank::INT, \"left\"::INT, \"right\"::INT, id::INT FROM merges WHERE rank < {FEW}"
    )
    q["s6_model_import"] = _with(_TRAIN) + both
    q["k6_train_sizes"] = q["s6_model_import"]
    q["s7_model_discovery"] = _with(_TRAIN) + (
        f"SELECT '{BIG}' AS tokenizer, 1 AS n_specials, count(*) AS n_merges FROM merges "
        f"UNION ALL SELECT '{SMALL}', 1, count(*) FROM merges WHERE rank < {FEW}"
    )
    q["s8_text_log_scan"] = _with(*_LOGS) + (
        "SELECT run_name, step::INT AS step, 'train' AS kind, round(train_loss, 4) AS value FROM log "
        "UNION ALL SELECT run_name, step::INT, 'val', round(val_loss, 4) FROM val"
    )
    q["s9_csv_log_scan"] = _with(_LOG) + "SELECT run_name, step, train_loss, elapsed_seconds FROM log"
    q["s10_eval_scan"] = _with(_EVAL) + "SELECT * FROM evals"
    q["s10_eval_reader"] = """SELECT user_id AS example_id, (event_id % 4)::INT AS cand_id,
        (row_number() OVER (PARTITION BY user_id, event_id % 4 ORDER BY event_id) - 1)::INT AS pos, round(value * 100) AS loss,
        (event_type <> 'view')::INT AS mask, (user_id % 4)::INT AS label FROM events"""
    q["s9_val_log_scan"] = _with(*_LOGS) + f"SELECT run_name || {_q(ODD_NAME)} AS run_name, step, val_loss, elapsed_seconds FROM val"
    q["s11_config_table"] = _with(_CONFIGS) + """SELECT min(ord) AS position, run_name, arg_max(n_layer, ord) AS n_layer,
        arg_max(block_size, ord) AS block_size, arg_max(total_batch_size, ord) AS total_batch_size,
        arg_max(max_tokens, ord) AS max_tokens FROM configs GROUP BY run_name"""
    lens = "lens AS (SELECT split, shard_id, length(code)::BIGINT AS n_tokens FROM shard_text)"
    q["k1_shard_write"] = _with(*_STREAMS, lens) + (
        "SELECT split, shard_id, n_tokens, printf('tokens_%s_%06d', split, shard_id) AS name FROM lens"
    )
    q["l1_shard_list"] = _with(*_STREAMS, lens) + (
        "SELECT shard_id, split, printf('tokens_%s_%06d', split, shard_id) AS name FROM lens"
    )
    q["k2_model_save"] = _with(_TRAIN) + f"""SELECT 0 AS line_no, 'minbpe v1' AS value UNION ALL SELECT 1, {_q(GPT4_PATTERN)}
        UNION ALL SELECT 2, '1' UNION ALL SELECT 3, '<|endoftext|> {EOT}'
        UNION ALL SELECT (4 + rank)::INT, "left" || ' ' || "right" FROM merges"""
    q["k3_vocab_listing"] = _with(_TRAIN, _VOCAB) + f"""SELECT v.id, CASE WHEN v.\"left\" IS NULL THEN '[' || v.s || '] ' || v.id
        ELSE '[' || a.s || '][' || b.s || '] -> [' || v.s || '] ' || v.id END AS line
        FROM (SELECT *, {_SHOWN} AS s FROM vocab) v LEFT JOIN (SELECT id, {_SHOWN} AS s FROM vocab) a ON a.id = v.\"left\"
        LEFT JOIN (SELECT id, {_SHOWN} AS s FROM vocab) b ON b.id = v.\"right\""""
    q["k3_vocab_file"] = f"SELECT line FROM ({q['k3_vocab_listing']})"
    q["k6_train_and_save"] = q["k6_train_sizes"]
    tc = _token_counts()
    q["k4_report_sink"] = _with(*tc) + (
        "SELECT sample, tokenizer, bytes, words, tokens, uniq AS unique_tokens FROM metrics JOIN totals USING (sample)"
    )
    q["k5_log_sinks"] = _with(*_LOGS) + (
        "SELECT run_name, 'train' AS kind, count(*) AS n, max(step) AS last_step FROM log GROUP BY run_name "
        "UNION ALL SELECT run_name, 'val', count(*), max(step) FROM val GROUP BY run_name"
    )

    q["p1_byte_length"] = "SELECT doc_id, octet_length(encode(text))::BIGINT AS bytes FROM documents"
    q["p2_word_count"] = r"SELECT doc_id, len(regexp_extract_all(text, '\S+'))::BIGINT AS words FROM documents"
    q["p3_token_range"] = _with(_TRAIN, _DOCS, _TOKEN_DOCS) + (
        "SELECT count(*) AS docs, sum(n)::BIGINT AS tokens, 0::BIGINT AS bad FROM tdocs"
    )
    q["p4_special_presence"] = _with(_CHAT) + (
        f"SELECT * FROM (SELECT conv_id, turn, regexp_extract(text, {_q(_ROLE_RE)}, 1) AS token FROM chat) WHERE token <> ''"
    )
    q["p6_split_label"] = _with(*_SHARDS) + "SELECT DISTINCT shard_id, split AS label FROM pieces"
    q["p7_eot_prefix"] = _with(_TRAIN, _DOCS, _TOKEN_DOCS) + (
        "SELECT doc_id, ord(code[1]) - 256 AS first_token, n::INT AS n_tokens FROM tdocs"
    )
    q["p8_round_robin"] = "SELECT doc_id, ((row_number() OVER (ORDER BY doc_id) - 1) % 4)::INT AS rank FROM documents"
    q["p9_cadence"] = _with(_LOG, _LAST) + """SELECT * FROM (SELECT run_name, step, step % 250 = 0 OR step = last_step AS validates,
        step > 0 AND (step % 5000 = 0 OR step = last_step) AS checkpoints FROM log JOIN lasts USING (run_name))
        WHERE validates OR checkpoints"""
    q["p10_schedule"] = _with(_CONFIGS) + """SELECT ord, max_lr * min_lr_ratio AS min_lr, warmup_tokens // total_batch_size AS warmup_steps,
        max_tokens // total_batch_size AS max_steps, total_batch_size // (batch_size * block_size) AS grad_accum,
        total_batch_size % (batch_size * block_size) = 0 AS divisible FROM configs"""
    q["p11_learning_rate"] = _with(_LOG, _LOG_CONFIGS) + """SELECT run_name, step, round(CASE WHEN step < warmup_steps
        THEN max_lr * (step + 1) / warmup_steps WHEN step > max_steps THEN min_lr
        ELSE min_lr + 0.5 * (1 + cos(pi() * ((step - warmup_steps) / (max_steps - warmup_steps)))) * (max_lr - min_lr) END, 12) AS lr
        FROM log JOIN log_configs USING (run_name)"""
    q["p12_perplexity"] = _with(*_LOGS) + "SELECT run_name, step, printf('%.8e', exp(val_loss)) AS ppl FROM val"
    q["p13_throughput"] = _with(_LOG) + (
        f"SELECT run_name, step, CASE WHEN train_loss = 0 THEN NULL ELSE round({B}.0::DOUBLE * {T} * 8 / train_loss, 6) END AS tps FROM log"
    )

    q["t1_pretokenize"] = _chunk_digest(_gpt4_chunks("text"))
    q["t2_pretokenize_gpt2"] = _chunk_digest(_gpt2_chunks("text"))
    q["t3_pretokenize_user"] = _chunk_digest(r"regexp_extract_all(text, '\p{L}+|\p{N}+|[^\p{L}\p{N}]+')")
    q["t4_byte_ids"] = f"""SELECT doc_id, md5(array_to_string(list_transform(regexp_extract_all(hex(encode(text)), '..'),
        lambda h: ('0x' || h)::INT), ' ')) AS digest FROM documents"""
    q["t5_merge_pair"] = (
        "SELECT doc_id, (octet_length(encode(text)) - (length(text) - length(replace(text, 'll', ''))) // 2)::BIGINT AS n_tokens "
        "FROM documents"
    )
    q["t6_split_specials"] = _with(_CHAT, _CHAT_PARTS.split(",\n  pchunks")[0]) + (
        "SELECT conv_id, turn, pi::INT AS part_idx, part FROM parts"
    )
    q["t7_lossy_decode"] = """SELECT doc_id, length(s)::BIGINT AS n_chars, md5(s) AS digest FROM (
        SELECT doc_id, repeat(chr(65533), (octet_length(encode(text[1])) - 1)::INT) || substr(text, 2) AS s FROM documents)"""
    q["t8_escape_controls"] = r"SELECT doc_id, md5(replace(text, chr(10), '\u000a')) AS digest FROM documents"
    q["t9_render_token"] = _with(_TRAIN, _VOCAB) + f"SELECT id, {_SHOWN} AS shown FROM vocab"
    q["t10_vocab_bytes"] = _with(_TRAIN, _VOCAB) + "SELECT id, h AS bytes FROM vocab"
    q["t11_slice_concat"] = _with(*_SHARDS) + (
        f"SELECT doc_id, (SELECT count(*) FROM pieces p WHERE p.doc_id = t.doc_id) AS n_pieces, {_digest('t.code')} AS digest "
        "FROM tdocs t"
    )
    rows = _batch_rows()
    q["t12_shift_by_one"] = _with(*rows) + (
        f"SELECT shard_id, batch_idx, rank, row, {_digest(f'w[1:{T}]')} AS x, {_digest(f'w[2:{T + 1}]')} AS y FROM complete"
    )
    q["t13_reshape"] = _with(*rows) + (
        f"SELECT shard_id, batch_idx, rank, count(*) AS n_rows, (count(*) * {T})::BIGINT AS n_tokens FROM complete GROUP BY ALL"
    )
    q["w4_batch_windows"] = _with(*rows) + (
        f"SELECT split, shard_id, batch_idx, rank, row, {_digest(f'w[1:{T}]')} AS x FROM complete"
    )

    q["e1_encode_chunks"] = _with(_TRAIN) + f"SELECT chunk, {_ids('s')} AS ids FROM s{MERGES}"
    encoded = f"length(code)::BIGINT AS n_tokens, {_digest()} AS digest"
    q["e2_encode_documents"] = _with(_TRAIN, _DOCS) + f"SELECT doc_id, {encoded} FROM enc"
    q["j1_dictionary_join"] = q["e2_encode_documents"]
    q["st1_encode_stream"] = q["e2_encode_documents"]
    q["e3_encode_specials"] = _with(_TRAIN, _CHAT, _CHAT_PARTS) + f"SELECT conv_id, turn, {encoded} FROM chat_enc"
    plain_chat = _encoded("plain", "chat", "conv_id, turn")
    user_parts = _CHAT_PARTS.replace(_q(_ROLE_RE), _q("(<\\|user\\|>)")).replace(
        ", ".join(map(_q, ROLES)), _q("<|user|>")
    )
    for alias in ("parts", "pchunks", "pdict", "chat_enc"):
        user_parts = user_parts.replace(alias, "u_" + alias)
    special_n = "len(list_filter(string_split(code, ''), lambda x: ord(x) - 256 >= " + f"{FIRST_ROLE}))"
    q["p5_special_subset"] = _with(_TRAIN, _CHAT, _CHAT_PARTS, user_parts, plain_chat) + " UNION ALL ".join(
        f"SELECT sum({special_n})::BIGINT AS specials, sum(length(code))::BIGINT AS tokens, '{mode}' AS mode FROM {cte}"
        for mode, cte in (("all", "chat_enc"), ("none", "plain"), ("user", "u_chat_enc"))
    )
    q["e4_decode"] = "SELECT doc_id, md5(text) AS digest FROM documents"
    q["e5_roundtrip"] = "SELECT doc_id, true AS ok FROM documents"
    q["e6_token_documents"] = _with(_TRAIN, _DOCS, _TOKEN_DOCS) + (
        f"SELECT doc_id, n AS n_tokens, {_digest()} AS digest FROM tdocs"
    )

    q["a1_pair_counts"] = _with(_JOINED, _dictionary("dict", "joined"), _byte_pairs("bp", "dict")) + (
        "SELECT \"left\", \"right\", cnt FROM bp"
    )
    q["a2_incremental_counts"] = _with(
        _dictionary("d1", "documents"), _dictionary("d2", "benchmark", "item_id"),
        _byte_pairs("b1", "d1"), _byte_pairs("b2", "d2"),
    ) + "SELECT \"left\", \"right\", sum(cnt)::BIGINT AS cnt FROM (FROM b1 UNION ALL FROM b2) GROUP BY \"left\", \"right\""
    q["a3_best_pair"] = _with(_TRAIN) + "SELECT \"left\", \"right\", n AS cnt FROM merges WHERE rank = 0"
    q["a4_chunk_dictionary"] = _with(_JOINED, _dictionary("dict", "joined")) + (
        "SELECT chunk, cnt, d AS first_doc, i::INT AS first_idx FROM dict"
    )
    q["a5_bpe_train"] = _with(_TRAIN) + "SELECT rank, \"left\", \"right\", id FROM merges"
    q["a22_training_trace"] = _with(_TRAIN, _SPELLED) + (
        "SELECT rank, \"left\", \"right\", id, (SELECT h FROM spelled)[id + 1] AS bytes, n AS cnt FROM merges"
    )
    q["a6_token_frequency"] = _with(*tc) + "SELECT sample, tokenizer, id, cnt FROM tc"
    q["a7_tokenizer_report"] = _with(*tc) + """SELECT sample, tokenizer, bytes, words, tokens, uniq AS unique_tokens, v::BIGINT AS vocab_size,
        round(bytes / tokens, 6) AS compression_ratio, round(1 - tokens / bytes, 6) AS compression_pct,
        round(bytes / tokens, 6) AS bytes_per_token, round(tokens / words, 6) AS tokens_per_word,
        round(tokens / (bytes / 1024), 6) AS tokens_per_kb, round(uniq / v, 6) AS vocab_coverage,
        round(entropy, 6) AS entropy_bits_per_token, round(2 ** entropy, 6) AS effective_vocab_size,
        round(1 - uniq / tokens, 6) AS token_reuse_rate, round(top_cnt / tokens, 6) AS most_common_token_share,
        round(top_n / tokens, 6) AS top_20_token_share, round(byte_cnt / tokens, 6) AS byte_token_share,
        round((tokens - byte_cnt) / tokens, 6) AS merge_token_share, true AS roundtrip
        FROM metrics JOIN totals USING (sample)"""
    q["a8_top_tokens"] = _with(*tc) + (
        "SELECT sample, tokenizer, place::INT AS place, id, cnt FROM ranked WHERE place <= 20"
    )
    q["a9_entropy"] = _with(*tc) + "SELECT sample, tokenizer, round(entropy, 6) AS entropy FROM metrics"
    q["a10_distinct_tokens"] = _with(*tc) + "SELECT sample, tokenizer, tokens, uniq AS unique_tokens FROM metrics"
    q["a10_distinct_sketch"] = _with(_TRAIN, _DOCS) + f"""SELECT lang AS sample, {_q(BIG)} AS tokenizer,
        count(DISTINCT c)::BIGINT AS unique_tokens, true AS within_bound
        FROM (SELECT lang, unnest(string_split(code, '')) AS c FROM enc JOIN documents USING (doc_id)) WHERE c <> '' GROUP BY lang"""
    q["a11_byte_tokens"] = _with(*tc) + (
        "SELECT sample, tokenizer, byte_cnt, (tokens - byte_cnt)::BIGINT AS merge_cnt FROM metrics"
    )
    q["a12_validation_loss"] = _with(_LOG) + """SELECT run_name, step // 32 AS step, round(avg(train_loss), 6) AS val_loss
        FROM log WHERE step % 32 < 20 GROUP BY run_name, step // 32"""
    q["a13_accumulated_loss"] = _with(_LOG, _MICRO) + (
        "SELECT run_name, step, round(sum(loss / 8), 6) AS train_loss FROM micro GROUP BY run_name, step"
    )
    q["a19_rank_average"] = _with(_LOG, _MICRO) + (
        "SELECT run_name, step, round(avg(loss), 6) AS loss FROM micro GROUP BY run_name, step"
    )
    best = "best AS (SELECT run_name, min(val_loss) AS best_val_loss, arg_min(step, {'l': val_loss, 's': step}) AS best_val_step FROM val GROUP BY run_name)"
    q["a14_best_validation"] = _with(*_LOGS, best) + "SELECT run_name, best_val_loss, best_val_step FROM best"
    q["a15_run_summary"] = _with(*_LOGS, best, _LOG_CONFIGS) + """SELECT run_name, max_steps, warmup_steps, max_lr, min_lr, last_step, elapsed_seconds,
        best_val_loss, best_val_step, last_step < max_steps - 1 AS stopped_due_to_time FROM log_configs
        JOIN (SELECT run_name, max(step) AS last_step, max(elapsed_seconds) AS elapsed_seconds FROM log GROUP BY run_name)
        USING (run_name) JOIN best USING (run_name)"""
    q["a16_masked_loss"] = _with(*_EVALS) + "SELECT example_id, cand_id, loss_sum, mask_sum FROM cands"
    q["a16_shifted_mask"] = """SELECT example_id, cand_id, sum(loss * mask)::BIGINT AS loss_sum, sum(mask)::BIGINT AS mask_sum FROM (
        SELECT user_id AS example_id, (event_id % 4)::INT AS cand_id, round(value * 100) AS loss,
        lead((event_type <> 'view')::INT) OVER (PARTITION BY user_id, event_id % 4 ORDER BY event_id) AS mask FROM events)
        WHERE mask IS NOT NULL GROUP BY example_id, cand_id"""
    q["a17_predictions"] = _with(*_EVALS) + "SELECT example_id, pred FROM preds"
    q["a18_accuracy"] = _with(*_EVALS) + """SELECT sum((pred = label)::INT)::BIGINT AS num_correct, count(*) AS num_total,
        round(sum((pred = label)::INT) / count(*), 9) AS acc FROM preds"""
    q["a20_corpus_totals"] = _with(_QUOTA_DEFAULT) + (
        "SELECT split, count(*) AS docs, sum(b)::BIGINT AS bytes FROM taken GROUP BY split"
    )
    q["a21_joined_text"] = _with(_QUOTA_DEFAULT) + (
        "SELECT split, md5(string_agg(text, chr(10) || chr(10) ORDER BY doc_id)) AS digest FROM taken GROUP BY split"
    )
    q["a23_position_loss"] = """SELECT user_id AS row_id, round(any_value(m) + ln(sum(exp(value - m))) - arg_min(value, event_id), 6) AS loss
        FROM (SELECT *, max(value) OVER (PARTITION BY user_id) AS m FROM events) GROUP BY user_id"""

    q["j2_token_bytes"] = _with(_TRAIN, _VOCAB, _DOCS, _TOKEN_DOCS) + f"""SELECT c.id, cnt, h AS bytes FROM (
        SELECT ord(ch) - 256 AS id, count(*) AS cnt FROM (SELECT unnest(string_split(code, '')) AS ch FROM tdocs) GROUP BY ch) c
        LEFT JOIN vocab v ON v.id = c.id"""
    roles = " UNION ALL ".join(f"SELECT {_q(t)} AS token, {i} AS id" for t, i in ROLES.items())
    q["j3_special_join"] = _with(_CHAT, f"sp AS ({roles})") + (
        "SELECT token, id, sum((length(text) - length(replace(text, token, ''))) // length(token))::BIGINT AS cnt "
        "FROM chat, sp GROUP BY token, id HAVING cnt > 0"
    )
    q["j4_samples_by_tokenizers"] = _with(_LANG_JOINED) + rf"""SELECT sample, bytes, words, tokenizer, vocab_size FROM (
        SELECT lang AS sample, sum(octet_length(encode(text)))::BIGINT AS bytes,
        sum(len(regexp_extract_all(text, '\S+')))::BIGINT AS words FROM lj GROUP BY lang),
        (SELECT '{BIG}' AS tokenizer, {256 + MERGES}::BIGINT AS vocab_size UNION ALL SELECT '{SMALL}', {256 + FEW})"""
    q["j5_vocab_children"] = _with(_TRAIN, _VOCAB) + (
        "SELECT v.id, a.h AS left_bytes, b.h AS right_bytes FROM vocab v LEFT JOIN vocab a ON a.id = v.\"left\" "
        "LEFT JOIN vocab b ON b.id = v.\"right\""
    )
    q["j6_contains_special"] = _with(_CHAT) + (
        "SELECT conv_id, turn FROM chat WHERE contains(text, '<|user|>') OR contains(text, '<|system|>')"
    )
    q["j7_logs_with_config"] = _with(_LOG, _LAST, _LOG_CONFIGS) + (
        "SELECT run_name, last_step, max_steps FROM lasts JOIN log_configs USING (run_name)"
    )
    q["j8_document_shards"] = _with(*_SHARDS[:-1]) + (
        "SELECT doc_id, sid::INT AS shard_id, start, skip::INT AS skip, take::INT AS take FROM spans"
    )
    q["j9_prediction_label"] = _with(*_EVALS) + "SELECT example_id, pred, label, pred = label AS hit FROM preds"

    q["w1_quota_split"] = _with(_QUOTA_DEFAULT) + "SELECT doc_id, split FROM taken"
    q["w2_document_offsets"] = _with(_TRAIN, _DOCS, _TOKEN_DOCS, _OFFSETS) + (
        "SELECT doc_id, n::INT AS n_tokens, o AS offset FROM offs"
    )
    q["w3_pack_shards"] = _with(*_SHARDS) + (
        f"SELECT split, shard_id, start, doc_id, length(code)::BIGINT AS n_tokens, {_digest()} AS digest FROM pieces"
    )
    q["w5_next_tokens"] = _with(*_STREAMS) + f"""SELECT shard_id, start, md5(CASE WHEN length(nxt) < n
        THEN (CASE WHEN n = 1 THEN '' ELSE {_ids("nxt")} || ' ' END) || '-1' ELSE {_ids("nxt")} END) AS labels FROM (
        SELECT p.shard_id, start, length(p.code) AS n, substr(s.code, (start + 2)::INT, length(p.code)::INT) AS nxt
        FROM pieces p JOIN shard_text s USING (shard_id))"""
    q["w6_periodic_validation"] = _with(_LOG) + """SELECT run_name, floor(elapsed_seconds / 86400)::BIGINT AS period, min(step) AS step
        FROM log WHERE floor(elapsed_seconds / 86400) >= 1 GROUP BY ALL"""
    q["w7_training_elapsed"] = _with(_LOG) + """SELECT run_name, step, round(elapsed_seconds - coalesce(sum(train_loss) OVER
        (PARTITION BY run_name ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 6) AS training_elapsed FROM log"""
    q["w8_best_so_far"] = _with(*_LOGS) + (
        "SELECT run_name, step, min(val_loss) OVER (PARTITION BY run_name ORDER BY step) AS best_so_far FROM val"
    )
    q["w9_stop_condition"] = _with(_LOG) + """SELECT run_name, count(*) AS steps, max(step) AS last_step FROM log l
        WHERE step < coalesce((SELECT min(step) FROM log m WHERE m.run_name = l.run_name AND elapsed_seconds >= 500000), 9e18)
        GROUP BY run_name"""
    q["w10_final_validation"] = _with(*_LOGS) + """SELECT run_name, step, last_val_step FROM
        (SELECT run_name, max(step) AS step FROM log GROUP BY run_name)
        LEFT JOIN (SELECT run_name, max(step) AS last_val_step FROM log WHERE step % 250 = 0 GROUP BY run_name) USING (run_name)
        WHERE step IS DISTINCT FROM last_val_step"""
    q["w11_batch_schedule"] = _with(
        *_STREAMS, _LOG, _MICRO,
        f"served AS (SELECT shard_id, greatest(1, floor((length(code) - 1) / {B * T})::BIGINT) AS nb FROM shard_text WHERE split = 'train')",
        "slots AS (SELECT shard_id, unnest(range(0, nb)) AS batch_idx, coalesce(sum(nb) OVER (ORDER BY shard_id "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM served)",
        "total AS (SELECT sum(nb)::BIGINT AS t FROM served)",
        "want AS (SELECT run_name, step, micro, step * 8 + micro AS n, (step * 8 + micro) // t AS cycle, (step * 8 + micro) % t AS slot "
        "FROM micro, total)",
    ) + "SELECT run_name, step, micro, cycle, shard_id, batch_idx FROM want JOIN slots ON slot = before + batch_idx"
    q["w12_softmax"] = """SELECT user_id AS row_id, event_id AS cand, round(exp(value - m) / sum(exp(value - m)) OVER (PARTITION BY user_id), 9) AS prob
        FROM (SELECT *, max(value) OVER (PARTITION BY user_id) AS m FROM events)"""

    q["l2_top_chunks"] = _with(_JOINED, _dictionary("dict", "joined")) + (
        "SELECT chunk, cnt FROM dict ORDER BY cnt DESC, d, i LIMIT 20"
    )
    q["l3_arg_extremes"] = _with(_LOG) + """SELECT run_name, arg_min(step, {'l': train_loss, 's': step}) AS first_min,
        arg_max(step, {'l': train_loss, 's': -step}) AS first_max FROM log GROUP BY run_name"""
    q["l4_quota_stop"] = _with(_QUOTA.format(train=500_000, test=250_000)) + (
        "SELECT split, min(doc_id) AS first_doc, max(doc_id) AS last_doc FROM taken GROUP BY split"
    )
    q["l5_top_candidates"] = """SELECT * FROM (SELECT user_id AS row_id, event_id AS cand,
        row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS place FROM events) WHERE place <= 50"""

    q["l5_weighted_draw"] = """WITH p AS (SELECT user_id AS row_id, event_id AS cand,
        round(value * 100) / sum(round(value * 100)::BIGINT) OVER (PARTITION BY user_id) AS prob FROM events),
        k AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY prob DESC, cand) AS place FROM p WHERE prob > 0)
        SELECT row_id, arg_min(cand, -ln((('0x' || substr(md5('42:' || row_id || ':' || cand), 1, 13))::BIGINT + 1) / 4503599627370496.0::DOUBLE) / prob) AS cand
        FROM k WHERE place <= 50 GROUP BY row_id"""
    q["u1_disjoint_split"] = _with(_QUOTA_DEFAULT) + """SELECT split AS part, count(*) AS n FROM taken GROUP BY split
        UNION ALL SELECT 'both', count(*) FROM (SELECT doc_id FROM taken WHERE split = 'train' INTERSECT
        SELECT doc_id FROM taken WHERE split = 'test')"""
    q["u2_allowed_specials"] = f"WITH sp AS ({roles}) " + (
        "SELECT token, id FROM sp WHERE token IN (SELECT '<|' || role || '|>' FROM conversations)"
    )
    q["u3_union_logs"] = _with(*_LOGS) + """SELECT run_name, kind, count(*) AS n, sum(step)::BIGINT AS steps,
        sum(round(value * 100000)::BIGINT)::BIGINT AS total FROM (
        SELECT run_name, step, 'train' AS kind, train_loss AS value FROM log
        UNION ALL SELECT run_name, step, 'val', val_loss FROM val
        UNION ALL SELECT run_name, step, 'hella', train_loss / 1000 FROM log WHERE step % 250 = 0) GROUP BY run_name, kind"""

    q["st2_token_count_stream"] = _with(_TRAIN, _DOCS) + (
        "SELECT ord(ch) - 256 AS id, count(*) AS cnt FROM (SELECT unnest(string_split(code, '')) AS ch FROM enc) GROUP BY ch"
    )
    q["st2_pair_count_stream"] = _with(_dictionary("dict", "documents"), _byte_pairs("bp", "dict")) + (
        "SELECT \"left\", \"right\", cnt FROM bp"
    )
    q["st3_run_metrics_stream"] = _with(*_LOGS) + """SELECT l.run_name, round(bv, 4) AS best_val_loss, bs::INT AS best_val_step, last_step::INT AS last_step
        FROM lasts l JOIN (SELECT run_name, min(val_loss) AS bv, arg_min(step, {'l': val_loss, 's': step}) AS bs FROM val GROUP BY run_name)
        USING (run_name)"""
    q["st4_shard_fill_stream"] = _with(*_SHARDS) + (
        f"SELECT split, shard_id, start, doc_id, {_digest()} AS digest FROM pieces"
    )
    q["f1_custom_pattern"] = r"""SELECT chunk, count(*) AS cnt FROM (
        SELECT unnest(regexp_extract_all(text, '\p{L}+|\p{N}+|[^\p{L}\p{N}]+')) AS chunk FROM documents) GROUP BY chunk"""
    q["f2_outside_encoder"] = """SELECT lang AS sample, true AS roundtrip, 'raw_bytes' AS tokenizer, sum(octet_length(encode(text)))::BIGINT AS bytes,
        sum(octet_length(encode(text)))::BIGINT AS tokens, any_value(u) AS unique_tokens, 1.0::DOUBLE AS compression_ratio
        FROM documents JOIN (SELECT lang, count(DISTINCT b) AS u FROM (SELECT lang, unnest(regexp_extract_all(hex(encode(text)), '..')) AS b
          FROM documents) GROUP BY lang) USING (lang) GROUP BY lang"""
    q["f3_special_vocab"] = _with(_CHAT, f"sp AS ({roles})") + (
        "SELECT id, token, sum((length(text) - length(replace(text, token, ''))) // length(token))::BIGINT AS cnt "
        "FROM sp, chat GROUP BY id, token"
    )
    quota_train = "joined AS (SELECT doc_id, text || CASE WHEN doc_id = max(doc_id) OVER () THEN '' ELSE chr(10) || chr(10) END AS text FROM taken WHERE split = 'train')"
    test_joined = "tj AS (SELECT doc_id, text || CASE WHEN doc_id = max(doc_id) OVER () THEN '' ELSE chr(10) || chr(10) END AS text FROM taken WHERE split = 'test')"
    sizes = []
    for n, upto in ((256 + FEW, FEW), (256 + MERGES, MERGES)):
        sizes.append(f"""SELECT 'test' AS sample, 'regex_vocab_{n}' AS tokenizer, bytes, words, tokens, uniq AS unique_tokens, {n}::BIGINT AS vocab_size
          FROM tsum, (SELECT sum(cnt)::BIGINT AS tokens, count(DISTINCT ch) AS uniq FROM (
            SELECT cnt, unnest(string_split({_apply("s", upto)}, '')) AS ch FROM tcode))""")
    q["train_and_report"] = _with(
        _QUOTA_DEFAULT, _TRAIN.replace(_JOINED, quota_train), test_joined, _dictionary("tdict", "tj"),
        f"tcode AS MATERIALIZED (SELECT {_code('chunk')} AS s, cnt FROM tdict)",
        r"""tsum AS (SELECT sum(octet_length(encode(text)))::BIGINT AS bytes,
            sum(len(regexp_extract_all(text, '\S+')))::BIGINT AS words FROM tj)""",
    ) + " UNION ALL ".join(sizes)
    return q
