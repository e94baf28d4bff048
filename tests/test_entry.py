import duckdb
import pytest

import __spark_entry__ as entry_module

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

# A cross-section; the driver compares every query at a larger scale.
NAMES = [
    "s4_named_samples", "s6_model_import", "s8_text_log_scan", "k1_shard_write", "k3_vocab_listing",
    "t1_pretokenize", "t2_pretokenize_gpt2", "e2_encode_documents", "e3_encode_specials",
    "a4_chunk_dictionary", "a7_tokenizer_report", "a8_top_tokens", "a15_run_summary", "a18_accuracy",
    "w1_quota_split", "w3_pack_shards", "w4_batch_windows", "w7_training_elapsed", "w11_batch_schedule",
    "train_and_report",
]


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(str(r[i]).lower() for i in order) for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, sf, duck, name):
    df = entry_module.queries()[name](spark, sf)
    result = duck.execute(entry_module.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


def test_every_sql_has_a_query():
    queries, sql = entry_module.queries(), entry_module.oracle_sql()
    assert set(sql) <= set(queries)
    core = {name for name in queries if name != "pipeline" and not name.startswith("op")}
    assert core <= set(sql)


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() == 2 and "entropy_bits_per_token" in df.columns
