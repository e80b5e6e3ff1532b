"""Every registered query against its DuckDB twin (the driver's gate) at sf0.001."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from ledgerlake.registry import QUERIES
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "total_tpv_brl" in df.columns


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = con.execute(ORACLE[name]).df()
    assert compare(got, want) == []
