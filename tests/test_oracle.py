"""Every registered query against its DuckDB oracle on the driver tables."""

from __future__ import annotations

import pytest

from conftest import SF0001

import __spark_entry__ as entry
from ledgerlens.registry import QUERIES
from ledgerlens.verify.compare import compare, duckdb_connection
from ledgerlens.verify.oracle import ORACLE

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF0001)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    res = compare(entry.queries()[name](spark, SF0001), entry.oracle_sql()[name], con)
    assert res["cols_match"], res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["exact"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["partner_id", "gross_collected", "commission", "marketing_fees",
                          "total_taxes", "partner_payment"]
    assert df.count() > 0
