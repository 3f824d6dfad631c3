"""Every registered query against its SQL check, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import DATA, connect, differences

SF_DIR = f"{DATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
CHECKS = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_matches_sql(spark, con, name):
    assert differences(spark, SF_DIR, entry.queries()[name], CHECKS[name], con) == []


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(CHECKS)))
def test_runs_without_check(spark, name):
    assert entry.queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
