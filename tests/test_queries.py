"""Every registered query against its SQL form, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from corpusloom.plans.registry import load_all
from tests.compare import connect, difference

ROOT = "/root/testdata/sf0.001"
# Queries without a SQL form, and those of the optional part, have tests of their own.
LIBRARY = load_all()
SQL = entry_points.oracle_sql()
QUERIES = {name: fn for name, fn in entry_points.queries().items() if name in SQL and name in LIBRARY}


@pytest.fixture(scope="module")
def con():
    return connect(ROOT)


#: Thousands of dependent merges have no SQL form; see test_models.py.
NO_SQL = {"bpe_merges", "bpe_encode", "bpe_decode", "ids_to_tokens", "vocab_roundtrip", "bpe_roundtrip", "response_labels_bpe", "metrics_report_bpe"}


def test_every_other_query_of_the_library_has_a_sql_form():
    assert {name for name, (_, sql) in LIBRARY.items() if sql is None} == NO_SQL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, ROOT), con, SQL[name]) is None


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["sft_messages", "pad_batches", "corpus_bleu", "bigram_loss", "stream_split"])
def test_no_cross_join(spark, name):
    plan = QUERIES[name](spark, ROOT)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_filter_and_columns_reach_the_scan(spark):
    plan = QUERIES["chat_training_text"](spark, ROOT)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(role,user)" in plan and "EqualTo(role,assistant)" in plan
    scan = QUERIES["project_text"](spark, ROOT)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<text:string>" in scan
