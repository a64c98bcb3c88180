"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from oracle_check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


#: Registered without SQL so far; what tests there are for them is in tests/llm.
WITHOUT_SQL = {
    "op1_page_text", "op2_packing", "op3_secret_scan", "op4_quality_classifier", "op5_language_id", "op7_sharding", "op8_quality_rules",
    "op9_decontamination", "op10_pii_pseudonyms", "pipeline",
}


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_equals_sql(spark, con, name):
    same, text = compare(spark, con, SF, name)
    assert same, text


def test_every_query_has_sql():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(entry.queries()) - set(entry.oracle_sql()) <= WITHOUT_SQL


def test_entry(spark):
    assert entry.entry(spark).count() > 0
