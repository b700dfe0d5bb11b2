"""Every named query against its SQL, and the contract of the entry module."""

import pytest

import __spark_entry__ as contract
from isobar.plans import registered
from tests.oracle import assert_same, connect


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(registered()))
def test_query_matches_sql(name, spark, sf_dir, duck):
    rows = assert_same(contract.queries()[name](spark, sf_dir), duck, contract.oracle_sql()[name])
    assert rows > 0


def test_every_query_has_sql():
    assert registered().keys() <= contract.queries().keys() & contract.oracle_sql().keys()


def test_entry_flags_readings(spark):
    flagged = contract.entry(spark)
    assert {"reading_id", "anomaly_type", "is_anomaly"} <= set(flagged.columns)
    assert flagged.count() == 1000
