"""R3 — settlement summary: one row per settlement group plus a TOTAL row.

Columns: settlement_link, input_date, settlement_from, settlement_to, gross_revenue,
collected_revenue, executed_commission_w_tax, cancelled_commission_w_tax,
advance_commission_w_tax, marketing_fees_w_tax, cash_advance_w_tax,
other_fees_w_tax, partner_settlement.

Unlike the invoice summary there is no status filter: every session appears,
purchased lines as advance commission.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerlens.functions import sqltext as sql
from ledgerlens.operators.fees import settlement_session_fees
from ledgerlens.operators.filters import NO_FILTER, RunFilter
from ledgerlens.operators.items import settlement_lines
from ledgerlens.operators.taxes import run_sessions, tax_rates
from ledgerlens.plans.totals import with_total
from ledgerlens.sources.catalog import Tables

MEASURES = ["gross_revenue", "collected_revenue", "executed_commission_w_tax",
            "cancelled_commission_w_tax", "advance_commission_w_tax", "marketing_fees_w_tax",
            "cash_advance_w_tax", "other_fees_w_tax", "partner_settlement"]
COLUMNS = ["settlement_link", "input_date", "settlement_from", "settlement_to"] + MEASURES


def settlement_detail(t: Tables, run_filter: RunFilter = NO_FILTER) -> DataFrame:
    base = run_filter.apply(t.sales)
    # a filtered run is one pass over the sales lines; a large whole one counts them first
    whole = run_filter.kind == "none"
    groups, run = run_sessions(settlement_lines(base, counted=whole), not whole,
                               "settlement-groups")
    fees = settlement_session_fees(t.fees, run, tax_rates(t.taxes, run))
    fin = groups.join(fees, "session_id", "left")
    mkt, cash, other = (sql.zero_if_null(c) for c in
                        ("marketing_fees_w_tax", "cash_advance_w_tax", "other_fees_w_tax"))
    deductions = sql.add("executed_commission_w_tax", "cancelled_commission_w_tax",
                         "advance_commission_w_tax", mkt, cash, other)
    dec = "decimal(34,10)"
    return fin.selectExpr(
        "settlement_link", "input_date", "period_from AS settlement_from",
        "period_to AS settlement_to",
        *[f"CAST({c} AS {dec}) AS {c}" for c in
          ("gross_revenue", "collected_revenue", "executed_commission_w_tax",
           "cancelled_commission_w_tax", "advance_commission_w_tax")],
        f"CAST({mkt} AS {dec}) AS marketing_fees_w_tax",
        f"CAST({cash} AS {dec}) AS cash_advance_w_tax",
        f"CAST({other} AS {dec}) AS other_fees_w_tax",
        f"{sql.sub('collected_revenue', deductions)} AS partner_settlement",
    )


def settlement_summary(t: Tables, run_filter: RunFilter = NO_FILTER) -> DataFrame:
    return with_total(settlement_detail(t, run_filter), "settlement_link", MEASURES)
