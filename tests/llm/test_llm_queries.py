"""The registered queries: against their SQL twins where there are any, by shape otherwise."""

from __future__ import annotations

import duckdb
import pytest

from tallyline.llm.oracle import SQL
from tallyline.llm.queries import QUERIES
from tests.oracle import check

TABLES = "documents pages conversations benchmark labels".split()


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf_dir, con, name):
    assert check(QUERIES[name](spark, sf_dir), con, SQL[name]) > 0


COLUMNS = {
    "op1_warc_round_trip": "page_id payload_bytes payload_digest record_type refers_to",
    "op2_lm_scores": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op4_chat_prefix_tree": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op5_main_text": "page_id url text n_chars",
    "op6_source_mixing": "doc_id size source_size target taken",
    "op9_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op10_histogram_shards": "doc_id size text_crc32 law shard slot grown_shard",
    "op11_secret_scan": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op12_ranked_search": "item_id rank doc_id score",
    "op13_periodic_runs": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
}


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_of_the_contract(spark, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    assert set(COLUMNS[name].split()) <= set(frame.columns)
    source = {"op1": "pages", "op5": "pages"}.get(name.split("_")[0], "documents")
    rows = frame.count()
    if name.startswith("op4"):
        turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
        assert rows == turns.select("conv_id").distinct().count() + 1
        hostile = frame.where("conv_id = -7").first()
        assert (hostile["n_turns"], hostile["loss_chars"]) == (2, len("</s>[INST] ok [/INST]"))
    elif name.startswith("op12"):
        assert rows == 10 * spark.read.parquet(f"{sf_dir}/benchmark.parquet").count()
    else:
        assert rows == spark.read.parquet(f"{sf_dir}/{source}.parquet").count()
