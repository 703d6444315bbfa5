"""Named queries: one per operator of the survey, each ``(spark, sf_dir) -> DataFrame``.

Every query derives its inputs from the driver tables under ``sf_dir`` and runs
over them whole. Money is cast to DOUBLE at the end for engine-neutral checks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.columns import money_to_double
from ledgerlens.sources.catalog import Tables

SF0001 = "/root/testdata/sf0.001"

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
# the same queries over any Tables (used by the randomized oracle tests)
TABLE_QUERIES: dict[str, tuple[Callable[[Tables], DataFrame], bool]] = {}


def query(name: str, doubles: bool = True):
    def deco(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(Tables.from_driver(spark, sf_dir))
            return money_to_double(df) if doubles else df

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        TABLE_QUERIES[name] = (fn, doubles)
        return fn

    return deco


# -- sources (S1-S4) -------------------------------------------------------------

@query("sales_lines_scan")
def _sales(t: Tables) -> DataFrame:
    return t.sales


@query("taxes_scan")
def _taxes(t: Tables) -> DataFrame:
    return t.taxes


@query("fees_scan")
def _fees(t: Tables) -> DataFrame:
    return t.fees


@query("accounts_scan")
def _accounts(t: Tables) -> DataFrame:
    return t.accounts


# -- shared inputs ------------------------------------------------------------------

from ledgerlens.functions.columns import with_partner_id  # noqa: E402
from ledgerlens.operators import commission as C  # noqa: E402
from ledgerlens.operators import fees as FE  # noqa: E402
from ledgerlens.operators import items as I  # noqa: E402
from ledgerlens.operators import taxes as TX  # noqa: E402
from ledgerlens.operators.daily import SettlementState  # noqa: E402
from ledgerlens.operators.filters import RunFilter  # noqa: E402
from ledgerlens.operators.lookup_index import LookupIndex  # noqa: E402
from ledgerlens.plans.invoice import invoice_summary  # noqa: E402
from ledgerlens.plans.partner import partner_summary  # noqa: E402
from ledgerlens.plans.settlement import settlement_summary  # noqa: E402
from ledgerlens.session import buckets_for, scratch_dir  # noqa: E402
from ledgerlens.sources.by_item import SalesByItem  # noqa: E402

# Fixed parameters of the filtered / lookup queries: a partner spelt with a
# thousands comma ("1,000") and a contract shared by several partners. Both
# exist at every driver scale factor.
PARTNER = 1000
CONTRACT = "C10-1"


def _rates(t: Tables) -> DataFrame:
    return TX.tax_rates(t.taxes, TX.sessions(t.sales))


# -- taxes, fees, commission (A1-A7, A11) --------------------------------------------

@query("tax_rates")
def _tax_rates(t: Tables) -> DataFrame:
    return _rates(t)


@query("fee_detail")
def _fee_detail(t: Tables) -> DataFrame:
    return FE.fee_detail(t.fees, TX.sessions(t.sales), _rates(t))


@query("session_fees_invoice")
def _session_fees_invoice(t: Tables) -> DataFrame:
    return FE.session_fees_invoice(FE.fee_detail(t.fees, TX.sessions(t.sales), _rates(t)))


@query("commission_by_invoice")
def _commission_by_invoice(t: Tables) -> DataFrame:
    return C.commission_by_invoice(t.sales, _rates(t))


@query("partner_commission")
def _partner_commission(t: Tables) -> DataFrame:
    base = with_partner_id(t.sales)
    return C.partner_commission(base, _rates(t))


@query("partner_marketing_fees")
def _partner_marketing_fees(t: Tables) -> DataFrame:
    return FE.partner_marketing_fees(t.fees, with_partner_id(t.sales), _rates(t))


@query("partner_settlement_fees")
def _partner_settlement_fees(t: Tables) -> DataFrame:
    return FE.partner_settlement_fees(t.fees, with_partner_id(t.sales), _rates(t))


@query("settlement_session_fees")
def _settlement_session_fees(t: Tables) -> DataFrame:
    return FE.settlement_session_fees(t.fees, TX.sessions(t.sales), _rates(t))


# -- items (A8-A10, A12) ---------------------------------------------------------------

@query("item_history")
def _item_history(t: Tables) -> DataFrame:
    return I.item_history(t.sales)


@query("consolidated_items")
def _consolidated_items(t: Tables) -> DataFrame:
    return I.consolidated_items(t.sales)


@query("consolidated_items_by_bucket")
def _consolidated_items_by_bucket(t: Tables) -> DataFrame:
    """A9 from the lines stored by item."""
    spark = t.sales.sparkSession
    copy = SalesByItem(spark, scratch_dir(spark, "sales-by-item"), buckets=buckets_for(t.sales))
    copy.write(t.sales)
    return copy.consolidated_items()


@query("partner_revenue")
def _partner_revenue(t: Tables) -> DataFrame:
    base = with_partner_id(t.sales)
    own = C.partner_totals(C.partner_pairs(C.partner_grain(base), _rates(t)))
    return I.partner_revenue(own, I.canceled_reversals(base))


@query("settlement_lines")
def _settlement_lines(t: Tables) -> DataFrame:
    return I.settlement_lines(t.sales)


def _state_of_two_days(t: Tables) -> SettlementState:
    """The whole history taken in as two days that share items and groups, the second
    day twice."""
    spark = t.sales.sparkSession
    state = SettlementState(spark, scratch_dir(spark, "settlement-state"),
                            buckets=buckets_for(t.sales))
    first = F.coalesce(F.col("plan_id") < 10, F.lit(True))
    state.ingest("2024-01-01", t.sales.where(first))
    state.ingest("2024-01-02", t.sales.where(~first))
    state.ingest("2024-01-02", t.sales.where(~first))
    return state


@query("settlement_lines_by_day")
def _settlement_lines_by_day(t: Tables) -> DataFrame:
    """A12 from the state that is carried from day to day."""
    return _state_of_two_days(t).settlement_lines()


@query("item_history_by_day")
def _item_history_by_day(t: Tables) -> DataFrame:
    """A8 from the state that is carried from day to day."""
    return _state_of_two_days(t).item_history()


# -- reports (R1-R3) with and without run filters ---------------------------------------

@query("invoice_summary")
def _invoice_summary(t: Tables) -> DataFrame:
    return invoice_summary(t)


@query("invoice_summary_by_partner")
def _invoice_summary_by_partner(t: Tables) -> DataFrame:
    return invoice_summary(t, RunFilter(partner_id=PARTNER))


@query("invoice_summary_partner_over_contract")
def _invoice_summary_partner_over_contract(t: Tables) -> DataFrame:
    """Both filters given: the partner wins, the contract is ignored (F3)."""
    return invoice_summary(t, RunFilter(partner_id=PARTNER, contract_code=CONTRACT))


@query("invoice_summary_by_contract")
def _invoice_summary_by_contract(t: Tables) -> DataFrame:
    return invoice_summary(t, RunFilter(contract_code=CONTRACT))


@query("partner_summary")
def _partner_summary(t: Tables) -> DataFrame:
    return partner_summary(t)


@query("partner_summary_by_contract")
def _partner_summary_by_contract(t: Tables) -> DataFrame:
    return partner_summary(t, RunFilter(contract_code=CONTRACT))


@query("settlement_summary")
def _settlement_summary(t: Tables) -> DataFrame:
    return settlement_summary(t)


@query("settlement_summary_by_partner")
def _settlement_summary_by_partner(t: Tables) -> DataFrame:
    return settlement_summary(t, RunFilter(partner_id=PARTNER))


# -- lookups (L1-L4) and their bulk forms ----------------------------------------------

from ledgerlens.operators import lookups as L  # noqa: E402


@query("lookup_partner_for_contract")
def _lookup_partner_for_contract(t: Tables) -> DataFrame:
    return L.partner_for_contract(t.sales, CONTRACT)


@query("lookup_contract_for_partner")
def _lookup_contract_for_partner(t: Tables) -> DataFrame:
    return L.contract_for_partner(t.sales, PARTNER)


@query("contracts_of_partner")
def _contracts_of_partner(t: Tables) -> DataFrame:
    return L.contracts_of_partner(t.sales, PARTNER)


@query("lookup_account_name")
def _lookup_account_name(t: Tables) -> DataFrame:
    return L.account_name(t.accounts, PARTNER)


@query("latest_partner_by_contract")
def _latest_partner_by_contract(t: Tables) -> DataFrame:
    return L.latest_partner_by_contract(t.sales)


@query("latest_contract_by_partner")
def _latest_contract_by_partner(t: Tables) -> DataFrame:
    return L.latest_contract_by_partner(t.sales)


def _index_of_two_halves(t: Tables) -> LookupIndex:
    """The whole history merged as two parts that share contracts and partners."""
    index = LookupIndex(t.sales.sparkSession, scratch_dir(t.sales.sparkSession, "lookup-index"),
                        buckets=16)
    first = F.coalesce(F.col("plan_id") < 10, F.lit(True))
    index.merge(t.sales.where(first))
    index.merge(t.sales.where(~first))
    return index


@query("indexed_partner_by_contract")
def _indexed_partner_by_contract(t: Tables) -> DataFrame:
    """L1 for every contract from the kept index."""
    return _index_of_two_halves(t).latest_partner_by_contract()


@query("indexed_contracts_of_partner")
def _indexed_contracts_of_partner(t: Tables) -> DataFrame:
    """L3 from one bucket of the kept index."""
    return _index_of_two_halves(t).contracts_of_partner(PARTNER)


# -- sinks (K1-K4) ----------------------------------------------------------------------

import datetime as _dt  # noqa: E402

from ledgerlens.functions.cells import report_cells  # noqa: E402

# Fixed run date of the registered job queries (the job takes it as a parameter).
RUN_DATE = _dt.date(2024, 1, 1)


@query("report_cells", doubles=False)
def _report_cells(t: Tables) -> DataFrame:
    """The partner summary as export cells (typed formatting)."""
    return report_cells(partner_summary(t))


@query("invoice_report_cells", doubles=False)
def _invoice_report_cells(t: Tables) -> DataFrame:
    """The invoice summary as export cells, numeric-looking text formatted too."""
    return report_cells(invoice_summary(t), legacy_strings=True)


@query("export_roundtrip", doubles=False)
def _export_roundtrip(t: Tables) -> DataFrame:
    """Export the partner summary as a CSV folder and read it back (K2)."""
    from ledgerlens.sinks.export import export_cells, read_cells

    spark = t.sales.sparkSession
    report, path = partner_summary(t), f"{scratch_dir(spark, 'exports')}/partner_summary"
    export_cells(report, path)
    return read_cells(spark, path, report.columns)


@query("snapshot_roundtrip")
def _snapshot_roundtrip(t: Tables) -> DataFrame:
    """Snapshot the partner summary to a dated folder and read it back."""
    from ledgerlens.sinks.snapshot import read_snapshot, snapshot

    spark = t.sales.sparkSession
    root = scratch_dir(spark, "snapshots")
    snapshot(partner_summary(t), root, "partner_summary", RUN_DATE)
    return read_snapshot(spark, root, "partner_summary", RUN_DATE)


@query("run_log")
def _run_log(t: Tables) -> DataFrame:
    """Run the whole partner-summary job; its run-log row without the wall-clock
    time (the only column that differs between runs)."""
    from ledgerlens.job import run

    spark = t.sales.sparkSession
    row = run(spark, t, "partner_summary", run_date=RUN_DATE, out=scratch_dir(spark, "job"))
    return row.select("status", "report", "rows_returned", "table_name", "run_date", "exported")
