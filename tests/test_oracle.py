"""Every registered query against its SQL counterpart; rows only where there is none."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, duck

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, con, name):
    assert compare(spark, name, SF_DIR, con) == []


# The whole search takes minutes; tests/test_models.py runs the registered query with stubbed fits.
SLOW = {"gbt_search"}


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql()) - SLOW))
def test_gives_rows(spark, name):
    assert entry.queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[0] == "dt_ref"
