"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import check
from tidewatch import catalog

SF = "/root/testdata/sf0.001"
catalog.load()


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return check.connect(SF)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, con, name):
    assert check.compare(con, catalog.QUERIES[name](spark, SF), catalog.ORACLES[name]) == ""


def test_flagship(spark):
    import __spark_entry__
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
