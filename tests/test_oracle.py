"""Every registered query equals its independent DuckDB oracle (row count, columns, value hash)."""

import re

import pytest

import __spark_entry__ as entry
from finsight import testing
from conftest import SF_SMOKE

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return testing.duck(SF_SMOKE)


def test_every_query_has_an_oracle():
    optional = re.compile(r"op\d+_|pipeline$")  # training-data operators have tests of their own
    missing = sorted(k for k in set(QUERIES) - set(ORACLES) if not optional.match(k))
    assert missing == [], missing


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, con, key):
    s = testing.spark_rows(QUERIES[key](spark, SF_SMOKE))
    d = testing.duck_rows(con, ORACLES[key])
    assert testing.fingerprint(*s) == testing.fingerprint(*d), testing.diff(s, d)
    assert testing.strict_diff(s, d) == []  # same value types, decimal scales and text


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns
