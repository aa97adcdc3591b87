"""Registered queries against their DuckDB oracle SQL at sf0.001."""
import pytest

import __spark_entry__ as E
from tests.oracle_compare import compare

SF = "/root/testdata/sf0.001"
KEYS = sorted(set(E.QUERIES) & set(E.oracle_sql()))  # the corpus queries have tests of their own


def test_every_query_has_an_oracle():
    missing = set(E.QUERIES) - set(E.oracle_sql())
    assert not missing, missing


@pytest.mark.parametrize("name", KEYS)
def test_matches_oracle(spark, duck_small, name):
    ok, msg = compare(E.queries()[name](spark, SF), E.oracle_sql()[name], duck_small)
    assert ok, msg


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "order_date" in df.columns
