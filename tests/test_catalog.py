"""Every registered query against its SQL on the smallest data folder."""

import pathlib

import pytest
from check_oracles import compare, connect

import __spark_entry__ as contract
from crowdlane.catalog import QUERIES

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not pathlib.Path(SF).exists(), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    got = contract.queries()[name](spark, SF).toArrow()
    assert compare(got, con.execute(contract.oracle_sql()[name]).to_arrow_table()) == "ok"


def test_entry(spark):
    assert contract.entry(spark).count() == 10
