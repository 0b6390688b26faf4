"""Every registered query against its SQL, over whole tables."""

import pytest

import __spark_entry__ as driver
from workload.oracles import ORACLES
from workload.queries import registered
from compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = {n: driver.queries()[n] for n in ORACLES}, ORACLES


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(registered()) == set(SQL) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, con, name):
    assert differences(con, QUERIES[name](spark, SF_DIR), SQL[name]) is None


def test_entry(spark):
    assert driver.entry(spark).count() > 0
