import pytest
from compare import connect, differences, duckdb_rows, spark_rows
from conftest import SF_DIR

import __spark_entry__ as contract
from tradewatch.plans.oracles import ORACLES


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, con, name):
    result = spark_rows(contract.queries()[name](spark, SF_DIR))
    assert differences(result, duckdb_rows(con, contract.oracle_sql()[name])) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
