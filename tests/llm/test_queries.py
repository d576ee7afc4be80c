import os

import pytest

from loomlog.llm import queries

from ..oracle import DATA, connect, same

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")

COLUMNS = {
    "op1_packing": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    "op2_token_counts": {"doc_id", "n_bytes", "n_tokens", "over_limit"},
    "op4_mixing": {"doc_id", "size", "source_size", "target", "taken"},
    "op5_ngram_join": {"doc_id", "n_shingles", "component_id"},
    "op7_lm_scoring": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op8_pii": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
    "op9_sharding": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
}


def test_queries_equal_their_sql(spark):
    con = connect()
    assert [n for n, sql in queries.ORACLES.items() if not same(spark, con, queries.QUERIES[n], sql)] == []


def test_queries_have_their_columns_and_all_rows(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").count()
    for name, columns in COLUMNS.items():
        out = queries.QUERIES[name](spark, DATA)
        assert columns <= set(out.columns), name
        n = out.count()
        assert n == docs or name == "op1_packing" and n >= docs, name
