import os

import __spark_entry__ as contract
import pytest
from compare import differences, duck

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, connection, name):
    frame = contract.queries()[name](spark, SF_DIR)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert frame.count() > 0
    else:
        assert differences(frame, connection.sql(sql)) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
