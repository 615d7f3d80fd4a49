"""Every registered query against its SQL check, and plan-wide rules."""

import pytest

import __spark_entry__ as contract
from tests import compare


@pytest.fixture(scope="module")
def connection(folder):
    return compare.oracle(folder)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_agrees(spark, connection, folder, name):
    assert compare.difference(spark, connection, folder, name) is None


def test_checks_belong_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
