"""Every query with SQL must agree with it on the smallest tables."""

import pytest

import __spark_entry__ as contract
from check import compare, connect
from tallyrank.session import release

from conftest import SMALL

ORACLE = contract.oracle_sql()
QUERIES = contract.queries()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SMALL).toPandas()
    release(spark)
    want = duck.execute(ORACLE[name]).df()
    assert compare(got, want) == "ok"


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_has_ranked_rows(spark):
    rows = contract.entry(spark)
    assert rows.columns == ["user_id", "item_id", "rank", "score"]
    assert rows.count() > 0
