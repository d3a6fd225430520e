"""Every query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from compare import difference, duck
from conftest import SF


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_agrees_with_sql(spark, con, name):
    problem = difference(spark, con, contract.queries()[name], contract.oracle_sql()[name], SF)
    assert problem is None


def test_entry_returns_months(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 6
    first = min(rows, key=lambda r: r["month"])
    assert first["month"] == "2025-12-01"
    assert round(first["negativity"], 9) == 0.227272727
