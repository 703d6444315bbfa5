"""R1 — invoice summary: one row per invoice group plus a TOTAL row.

Columns: invoice_id, input_date, period_from, period_to, invoice_link,
commission, fixed_fees, total_share, taxes.

Only sessions with validated or canceled lines appear, so the fees of a session
with nothing but purchased lines are not reported. A session's fee sum is
repeated on each of its invoice rows (and counted that often in TOTAL).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import sqltext as sql
from ledgerlens.operators.commission import (INVOICE_KEYS, commission_by_plan, commission_totals,
                                             rate_plans)
from ledgerlens.operators.fees import fee_detail, session_fees_invoice
from ledgerlens.operators.filters import NO_FILTER, RunFilter
from ledgerlens.operators.taxes import run_sessions, tax_rates
from ledgerlens.plans.totals import with_total
from ledgerlens.sources.catalog import Tables

COLUMNS = ["invoice_id", "input_date", "period_from", "period_to", "invoice_link",
           "commission", "fixed_fees", "total_share", "taxes"]
MEASURES = ["commission", "fixed_fees", "total_share", "taxes"]


def invoice_detail(t: Tables, run_filter: RunFilter = NO_FILTER) -> DataFrame:
    base = run_filter.apply(t.sales).withColumn("invoice_id", F.col("invoice_id").cast("string"))
    keys = list(INVOICE_KEYS)
    # one pass over the sales lines: everything else joins their aggregate
    by_plan, run = run_sessions(commission_by_plan(base, keys), run_filter.kind != "none",
                                "invoice-commission")
    rates = tax_rates(t.taxes, run)
    comm = commission_totals(rate_plans(by_plan, rates), keys)
    fees = session_fees_invoice(fee_detail(t.fees, run, rates))
    fin = comm.join(fees, "session_id", "left")
    fee, fee_tax = sql.zero_if_null("fee_invoice"), sql.zero_if_null("fee_invoice_tax")
    return fin.selectExpr(
        "invoice_id", "input_date", "period_from", "period_to", "invoice_link",
        "CAST(commission AS decimal(34,10)) AS commission",
        f"CAST({fee} AS decimal(34,10)) AS fixed_fees",
        f"{sql.add('commission', fee)} AS total_share",
        # no fallback on the commission tax: NULL stays NULL, as in the source
        f"{sql.add('commission_tax', fee_tax)} AS taxes",
    )


def invoice_summary(t: Tables, run_filter: RunFilter = NO_FILTER) -> DataFrame:
    return with_total(invoice_detail(t, run_filter), "invoice_id", MEASURES)
