"""Plan shape: what the physical plans must (not) contain at any scale."""

from __future__ import annotations

import re

import pytest

from conftest import SF0001

from ledgerlens.operators import lookups as L
from ledgerlens.operators.filters import RunFilter
from ledgerlens.operators.items import consolidated_items, settlement_lines
from ledgerlens.plans.invoice import invoice_summary
from ledgerlens.plans.partner import partner_summary
from ledgerlens.plans.settlement import settlement_summary
from ledgerlens.session import scratch_dir
from ledgerlens.sources.catalog import Tables


@pytest.fixture(scope="module")
def tables(spark):
    return Tables.from_driver(spark, SF0001).materialize(scratch_dir(spark, "plan-tables"))


def full_plan(df) -> str:
    """Final and initial adaptive plan (AQE drops branches it proves empty)."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    return full_plan(df).split("== Initial Plan ==")[0]


@pytest.fixture
def stored_plans(monkeypatch):
    """Plans of what a report stores on the way: its lines in a filtered run, its detail."""
    from ledgerlens.session import stored

    plans = []

    def spy(df, name):
        plans.append(full_plan(df))
        return stored(df, name)

    monkeypatch.setattr("ledgerlens.plans.totals.stored", spy)
    monkeypatch.setattr("ledgerlens.operators.taxes.stored", spy)
    return plans


REPORTS = {
    "invoice": invoice_summary,
    "partner": partner_summary,
    "settlement": settlement_summary,
}


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_no_python_and_no_cartesian(tables, name, stored_plans):
    plan = "".join([final_plan(REPORTS[name](tables)), *stored_plans])
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                "BroadcastNestedLoopJoin", "FlatMapGroupsInPandas"):
        assert bad not in plan, bad


def sales_scans(plan: str) -> int:
    return sum("Scan parquet" in line and "sales_lines" in line for line in plan.splitlines())


def operators_above_scan(plan: str) -> list[str]:
    """Names of the operators from the (only) sales scan upwards."""
    names = [re.search(r"[A-Z]\w+", line) for line in plan.splitlines()]
    lines = [(n.group(), line) for n, line in zip(names, plan.splitlines()) if n]
    at = next(i for i, (_, line) in enumerate(lines) if "Scan parquet" in line)
    return [n for n, _ in reversed(lines[:at])]


@pytest.mark.parametrize("build,scans", [
    (lambda t: settlement_lines(t.sales), 1), (partner_summary, 2),
    (lambda t: consolidated_items(t.sales), 2)])
def test_scans_of_the_fact(tables, build, scans):
    assert sales_scans(final_plan(build(tables))) == scans


def test_settlement_lines_shuffle_aggregates_only(tables):
    plan = final_plan(settlement_lines(tables.sales))
    assert "SortAggregate" not in plan and "Join" not in plan
    assert plan.count("Exchange hashpartitioning") == 3  # lines, items, groups
    first = [n for n in operators_above_scan(plan) if n in ("HashAggregate", "Exchange")]
    assert first[:2] == ["HashAggregate", "Exchange"]


def test_contract_filter_reaches_parquet(tables, stored_plans):
    invoice_summary(tables, RunFilter(contract_code="C10-1"))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(contract_code,C10-1\)", stored_plans[0])


def test_partner_filter_reaches_parquet_through_stored_id(tables, stored_plans):
    invoice_summary(tables, RunFilter(partner_id=1000))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(partner_id,1000\)", stored_plans[0])


def test_column_pruning_on_the_fact(tables, stored_plans):
    invoice_summary(tables)
    found = re.findall(r"sales_lines\].*?ReadSchema: struct<([^>]*)>", stored_plans[0])
    assert found
    for schema in found:
        assert "gross_amount" not in schema and "settlement_link" not in schema


def test_bulk_lookup_hashes_the_fact_first(tables):
    plan = final_plan(L.latest_partner_by_contract(tables.sales))
    assert "Window" not in plan
    above = [n for n in operators_above_scan(plan) if n.endswith("Aggregate") or n == "Sort"]
    assert above[:2] == ["HashAggregate", "HashAggregate"]


def test_single_lookup_is_a_top_k_not_a_sort(tables):
    df = L.partner_for_contract(tables.sales, "C10-1")
    plan = final_plan(df)
    assert "TakeOrderedAndProject" in plan


def nodes(plan: str, name: str) -> int:
    return sum(re.match(rf"[\s:+*()\d-]*{name}\b", line) is not None for line in plan.splitlines())


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_filtered_run_aggregates_only_its_sessions(tables, name, monkeypatch):
    """J1: taxes and fees meet the run's stored sessions before they are aggregated, and
    the sessions come from the run's aggregated lines, not from a second pass."""
    from ledgerlens.operators import taxes as TX

    seen = {}
    real = TX.tax_rates
    for module in ("invoice", "partner", "settlement"):
        monkeypatch.setattr(f"ledgerlens.plans.{module}.tax_rates",
                            lambda taxes, ids=None: seen.setdefault("rates", real(taxes, ids)))
    run = RunFilter(partner_id=995)
    report = REPORTS[name](tables, run)
    mine = {r.session_id for r in run.apply(tables.sales).select("session_id").distinct().collect()}
    rates = seen["rates"]
    assert {r.session_id for r in rates.select("session_id").collect()} == mine
    assert rates.count() < real(tables.taxes).count() / 3
    plan = final_plan(rates)
    assert plan.index("HashAggregate") < plan.index("LeftSemi") and sales_scans(plan) == 0
    assert sales_scans(final_plan(report)) <= (name == "partner")  # its reversals


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_one_tax_scan_a_report(tables, name):
    """J4 and J5 look a rate up in one map: one aggregation of the taxes, read again by
    the second join from its exchange."""
    built = []
    real = {"invoice": "invoice_detail", "settlement": "settlement_detail"}
    if name in real:  # the report's last step reads the stored detail
        import importlib

        module = importlib.import_module(f"ledgerlens.plans.{name}")
        built.append(getattr(module, real[name])(tables))
    else:
        built.append(partner_summary(tables))
    plan = final_plan(built[0])
    assert sum("Scan parquet" in line and "taxes]" in line for line in plan.splitlines()) == 1


@pytest.mark.parametrize("build", [invoice_summary, settlement_summary])
def test_total_joins_nothing_again(tables, build):
    """A13: TOTAL and detail read the stored detail."""
    plan = final_plan(build(tables))
    assert "Join" not in plan and sales_scans(plan) == 0


def test_settlement_detail_joins_once(tables):
    from ledgerlens.plans.settlement import settlement_detail

    plan = final_plan(settlement_detail(tables))
    assert len(re.findall(r"(?:SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin) \[", plan)) == 2
