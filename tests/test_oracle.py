"""Every registered query equals its DuckDB oracle (rows, columns, values)."""

import pytest

from tests.conftest import SF001
from tests.oracle_compare import compare, duck

import __spark_entry__ as E
from salesmart.plans.queries import REGISTRY

QUERIES = {n: q for n, q in E.queries().items() if n in REGISTRY}
ORACLE = {n: s for n, s in E.oracle_sql().items() if n in REGISTRY}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_and_plan_shape(spark, con, name):
    """Rows equal the oracle, and the plan funnels no data through one partition and
    """
    from tests.test_plans import check_plan
    df = QUERIES[name](spark, SF001)
    check_plan(name, df)
    problems, _, _ = compare(spark, con, name, lambda s, d: df, ORACLE[name], SF001)
    assert not problems, problems


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["date_key", "customer_key", "product_key", "status_key", "source_key",
                          "order_number", "quantity", "unit_price", "total_amount"]
    assert df.count() > 0
