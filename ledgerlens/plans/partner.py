"""R2 — partner summary: one row per partner (the default report).

Columns: partner_id, gross_collected, commission, marketing_fees, total_taxes,
partner_payment, where

* gross_collected = collected revenue of non-purchased lines (reversals applied)
* commission      = ticketing commission (validated + canceled lines)
* marketing_fees  = invoice-side marketing fees — shown, not subtracted
* total_taxes     = commission tax + the settlement taxes of the five fee types
* partner_payment = gross_collected - commission - settlement fees - total_taxes

Partners are grouped by the normalized id (commas stripped) everywhere. No
TOTAL row; zero rows when the filter matches nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import sqltext as sql
from ledgerlens.functions.columns import with_partner_id
from ledgerlens.operators.commission import partner_grain, partner_pairs, partner_totals
from ledgerlens.operators.fees import (PARTNER_FEE_BUCKETS, PARTNER_FEE_MEASURES, attributed,
                                       partner_session_fee_totals, with_partner_count)
from ledgerlens.operators.filters import NO_FILTER, RunFilter
from ledgerlens.operators.items import canceled_reversals
from ledgerlens.operators.taxes import run_sessions, tax_rates
from ledgerlens.sources.catalog import Tables

COLUMNS = ["partner_id", "gross_collected", "commission", "marketing_fees", "total_taxes",
           "partner_payment"]


def partner_summary(t: Tables, run_filter: RunFilter = NO_FILTER) -> DataFrame:
    """The registered partner operators in one chain over the sales lines:

    lines -> (session, partner) totals, k = partners of the session
          -> + session fee totals x k -> per partner -> + reversals (the second
    pass over the lines).
    """
    base = with_partner_id(run_filter.apply(t.sales))
    grain, run = run_sessions(partner_grain(base), run_filter.kind != "none", "partner-grain")
    rates = tax_rates(t.taxes, run)
    pairs = with_partner_count(partner_pairs(grain, rates))
    fees = partner_session_fee_totals(t.fees, rates, run)
    per_partner = partner_totals(pairs.join(fees, "session_id", "left"),
                                 *attributed(PARTNER_FEE_MEASURES))
    reversals = canceled_reversals(base).withColumnRenamed("v", "reversed")
    joined = per_partner.join(reversals, "partner_id", "left")

    # a NULL partner never matches in the source's joins: its row is all zeros
    def val(c: str) -> str:
        return f"CASE WHEN partner_id IS NULL THEN 0 ELSE coalesce({c}, 0) END"

    gross = sql.add(val("own"), val("reversed"))
    commission = val("commission")
    fee_tax = sql.add(*[val(f"{p}_tax") for _, p, _ in PARTNER_FEE_BUCKETS])
    fee_sum = sql.add(*[val(f"{p}_fees") for _, p, _ in PARTNER_FEE_BUCKETS])
    total_taxes = sql.add(val("commission_tax"), fee_tax)
    payment = sql.sub(sql.sub(sql.sub(gross, commission), fee_sum), total_taxes)
    dec = "decimal(34,10)"
    return joined.select(
        "partner_id",
        sql.col(f"CAST({gross} AS {dec})", "gross_collected"),
        sql.col(f"CAST({commission} AS {dec})", "commission"),
        sql.col(f"CAST({val('invoice_marketing_fees')} AS {dec})", "marketing_fees"),
        sql.col(total_taxes, "total_taxes"),
        sql.col(payment, "partner_payment"),
    ).orderBy(F.col("partner_id").asc_nulls_first())
