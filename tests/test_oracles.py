"""Every registered query against its SQL twin at sf0.01 (the driver's correctness check),
and a rows-only run of the queries without a twin."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from oracle import compare, duck_connection

SF = os.environ.get("KILN_TEST_SF", "/root/testdata/sf0.01")
QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_sql_twin(spark, duck, key):
    got = QUERIES[key](spark, SF).toPandas()
    want = duck.execute(ORACLES[key]).df()
    assert compare(got, want) == []


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_queries_run(spark, key):
    df = QUERIES[key](spark, SF)
    assert df.count() > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert [f.name for f in df.schema.fields] == ["check", "feature", "value", "threshold", "is_anomaly"]
