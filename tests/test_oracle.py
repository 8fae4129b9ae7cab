"""Every query against its SQL on the smallest tables; where these give no rows, on the next larger ones."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import ROOT, compare, connect

SF, LARGER = f"{ROOT}/sf0.001", f"{ROOT}/sf0.01"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.fixture(scope="module")
def larger():
    return connect(LARGER)


def test_every_query_but_the_random_one_has_sql():
    assert {q for q in set(queries()) - set(SQL) if not q.startswith("op") and q != "pipeline"} == {"impute_forest"}
    assert set(SQL) <= set(queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_equal(spark, con, larger, name):
    diff, rows = compare(queries()[name](spark, SF), con, SQL[name])
    assert not diff
    if not rows:
        diff, rows = compare(queries()[name](spark, LARGER), larger, SQL[name])
        assert rows and not diff


def test_entry(spark):
    assert entry(spark).count() > 0
