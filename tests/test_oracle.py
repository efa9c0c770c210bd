"""Every query against its SQL counterpart on the smallest test tables."""

import os

import pytest

import __spark_entry__ as contract
from check_oracle import compare
from perennial.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_is_the_flagship(spark):
    df = contract.entry(spark)
    assert "timeless_score" in df.columns and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    rows, _seconds, problem = compare(
        spark, SF_DIR, name, contract.queries()[name], contract.oracle_sql()[name]
    )
    assert not problem and rows > 0
