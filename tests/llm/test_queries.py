"""Registered queries: those with SQL against it, the others for their columns."""

import pytest

import __spark_entry__ as entry
from mapledger.checks.compare import connect, difference
from mapledger.llm import queries

from ..conftest import TESTDATA

COLUMNS = {
    "op1_main_text": "page_id url text n_chars",
    "op2_ppm_score": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op3_pack": "doc_id piece start length ids_crc32 sequence_id offset",
    "op4_decontaminate": "doc_id item_id similarity start_word n_words",
    "op7_languages": "doc_id held_out lang_pred score",
    "op8_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op10_licenses": "doc_id license dice n_passages",
    "op11_toxicity": "doc_id held_out score predicted sentence_score sentence_start sentence_end",
    "op13_alignment": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
}


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query_against_sql(spark, name):
    assert difference(queries.queries()[name](spark, TESTDATA), connect(TESTDATA), queries.oracle_sql()[name]) is None


def test_columns(spark):
    for name, columns in COLUMNS.items():
        assert queries.queries()[name](spark, TESTDATA).columns == columns.split(), name


def test_registered():
    assert set(queries.queries()) == set(COLUMNS) | set(queries.oracle_sql())
    assert set(entry.queries()) >= {*queries.queries(), "pipeline"}


@pytest.mark.parametrize("name", ["op4_decontaminate", "op9_chat", "op10_licenses"])
def test_native(spark, name):
    plan = queries.queries()[name](spark, TESTDATA)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
