"""The kept lookup index against scans of all lines merged so far."""

from __future__ import annotations

import re

import pytest

from conftest import make_tables, sale
from test_random_oracle import random_tables

from ledgerlens.operators import lookups as L
from ledgerlens.operators.lookup_index import LookupIndex
from ledgerlens.session import scratch_dir


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def same(index, spark, lines):
    sales = make_tables(spark, lines).sales
    for got, want in ((index.latest_partner_by_contract(), L.latest_partner_by_contract(sales)),
                      (index.latest_contract_by_partner(), L.latest_contract_by_partner(sales))):
        assert rows(got) == rows(want)
    for code in ("C10-1", "C2", "none"):
        assert rows(index.partner_for_contract(code)) == rows(L.partner_for_contract(sales, code))
    for partner in (1000, 1001, 7, 5):
        assert rows(index.contract_for_partner(partner)) == rows(
            L.contract_for_partner(sales, partner))
        assert index.contracts_of_partner(partner).collect() == L.contracts_of_partner(
            sales, partner).collect()


@pytest.mark.parametrize("seed", [1])
def test_after_several_merges(spark, seed):
    lines = random_tables(seed)["sales_lines"]
    index = LookupIndex(spark, scratch_dir(spark, "lookup"), buckets=4)
    assert rows(index.latest_partner_by_contract()) == []
    for n in range(3):
        index.merge(make_tables(spark, lines[n::3]).sales)
        same(index, spark, [r for k in range(n + 1) for r in lines[k::3]])
    index.merge(make_tables(spark, lines[1::3]).sales)  # again
    same(index, spark, lines)
    same(LookupIndex(spark.newSession(), index.root), spark, lines)


def test_a_failed_merge_leaves_the_index(spark, monkeypatch):
    lines = [sale(contract_code="A"), sale(contract_code="B", partner_raw="7")]
    index = LookupIndex(spark, scratch_dir(spark, "lookup"), buckets=4)
    index.merge(make_tables(spark, lines).sales)

    def lost(*args):
        raise OSError("lost")

    monkeypatch.setattr(index.files, "replace", lost)
    with pytest.raises(OSError):
        index.merge(make_tables(spark, [sale(contract_code="C")]).sales)
    same(index, spark, lines)
    same(LookupIndex(spark, index.root), spark, lines)


def test_a_lookup_reads_one_bucket(spark):
    index = LookupIndex(spark, scratch_dir(spark, "lookup"), buckets=16)
    index.merge(make_tables(spark, [sale(contract_code=f"C{i}", partner_raw=str(i))
                                    for i in range(60)]).sales)
    # the files of other buckets are left out either way; the plan says so only when
    # it also keeps the bucketing
    auto = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    spark.conf.set(auto, "false")
    try:
        for df in (index.partner_for_contract("C7"), index.contract_for_partner(7),
                   index.contracts_of_partner(7)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert re.search(r"SelectedBucketsCount: 1 out of 16", plan)
    finally:
        spark.conf.unset(auto)
    plan = index.latest_contract_by_partner()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
