"""Queries with SQL against the SQL, the others run on whole tables with a stable schema."""

import pytest

from postweave.llm import queries
from tests import oracle

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "p1_found": ["group_key", "field_name", "record_key"], "p3_found": ["field_name", "key_a", "key_b"], "p4_found": ["batch_row_id", "offer_key"], "p5_found": ["provider_key", "group_key"],
    "p6_found": ["field_name", "record_key", "pii_type", "start_pos"], "p8_ids": ["doc_id", "ids"], "p9_found": ["doc_id", "item_id"], "p10_found": ["doc_id"],
}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, name):
    cols, mine = oracle.rows_of_spark(queries.QUERIES[name](spark, SF))
    names, theirs = oracle.rows_of_sql(oracle.connect(SF), queries.SQL[name])
    assert cols == names and mine == theirs


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_runs(spark, name):
    df = queries.QUERIES[name](spark, SF)
    assert df.count() > 0
    assert name not in COLUMNS or df.columns == COLUMNS[name]
