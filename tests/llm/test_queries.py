"""The registered queries that SQL can express, against their SQL; all of them for their columns."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))
import check_oracle  # noqa: E402

from courtside.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = {
    "op1_quality": "doc_id held_out score predicted",
    "op2_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op3_toxicity": "doc_id held_out score predicted",
    "op4_embedding_dedup": "vec_id n_links component_id kept",
    "op5_jaccard_join": "doc_id class_id n_links",
    "op6_language_id": "doc_id held_out lang_pred score",
    "op7_chat": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op8_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op9_language_model": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op10_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    assert check_oracle.compare(spark, check_oracle.connect(SF), SF, name) == ""


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_has_a_row_for_everything(spark, name):
    found = QUERIES[name](spark, SF)
    assert found.columns == COLUMNS[name].split()
    table = {"op4": "embeddings", "op7": "conversations"}.get(name.split("_")[0], "documents")
    whole = spark.read.parquet(f"{SF}/{table}.parquet")
    key = found.columns[0]
    assert found.count() == whole.select(key).distinct().count() + (name == "op7_chat")
