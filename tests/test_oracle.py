"""Every core query with SQL gives what the SQL gives, on whole tables."""

import pytest

from postweave.plans import registry
from tests import oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_matches_sql(spark, duck, name):
    cols, mine = oracle.rows_of_spark(registry.QUERIES[name](spark, SF))
    names, theirs = oracle.rows_of_sql(duck, registry.SQL[name])
    assert cols == names
    assert mine == theirs


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_runs(spark, name):
    df = registry.QUERIES[name](spark, SF)
    assert df.count() >= 0 and df.columns
