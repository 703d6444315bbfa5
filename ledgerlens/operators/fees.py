"""Fixed fees per session: invoice view, settlement buckets and partner view.

The three reports read the fee table by different rules on purpose (which
amount, which category column, when tax applies); each rule lives in its own
function so they can not drift into one another:

=====================  =================  ==================  ======================
                       invoice            partner             settlement
=====================  =================  ==================  ======================
amount                 fee_invoice        both                fee_settlement
category from          (none)             fee_type            fee_description
apply_tax NULL         taxed              not taxed           taxed (cash adv.: no)
marketing, tax FALSE   not taxed          not taxed           taxed
=====================  =================  ==================  ======================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens import schemas as S
from ledgerlens.functions import sqltext as sql
from ledgerlens.functions.columns import AMOUNT_SUM, TAX_SUM
from ledgerlens.operators.taxes import attach_rates


def _session_fees(fees: DataFrame, session_ids: DataFrame | None) -> DataFrame:
    """Fees of the sessions in the run (``session_ids`` is distinct: 1:1); all
    fees when ``session_ids`` is None (the caller's join restricts them)."""
    if session_ids is None:
        return fees
    return fees.join(session_ids, "session_id", "left_semi")


def fee_detail(fees: DataFrame, session_ids: DataFrame | None, rates: DataFrame) -> DataFrame:
    """A2: one row per fee with its resolved rate, invoice tax and rate source.
    Tax is suppressed only when apply_tax is FALSE (TRUE and NULL are taxed)."""
    f = attach_rates(_session_fees(fees, session_ids), rates, "fee_description")
    return f.selectExpr(
        "session_id", "contract_code", "fee_description", "fee_invoice", "tax_rate",
        "CASE WHEN apply_tax = false THEN 0 ELSE fee_invoice * tax_rate END AS fee_invoice_tax",
        "tax_source")


def session_fees_invoice(detail: DataFrame) -> DataFrame:
    """A3: session -> summed invoice fee and its tax."""
    return detail.groupBy("session_id").agg(
        sql.col(sql.sum_as("fee_invoice", AMOUNT_SUM), "fee_invoice"),
        sql.col(sql.sum_as("fee_invoice_tax", TAX_SUM), "fee_invoice_tax"),
    )


def settlement_session_fees(fees: DataFrame, session_ids: DataFrame | None,
                            rates: DataFrame) -> DataFrame:
    """A11: session -> settlement fee buckets by *description*, tax included.

    marketing: always taxed; cash advance: never taxed; any other description:
    taxed unless apply_tax is FALSE; a NULL description is in no bucket.
    """
    f = attach_rates(_session_fees(fees, session_ids), rates, "fee_description")
    mkt, cash = sql.lit(S.FEE_MARKETING), sql.lit(S.FEE_CASH_ADVANCE)
    with_tax = "(fee_settlement + fee_settlement * tax_rate)"
    other = f"CASE WHEN apply_tax = false THEN fee_settlement ELSE {with_tax} END"

    def bucket(when: str, value: str, type_: str, alias: str) -> Column:
        total = sql.sum_as(f"CASE WHEN {when} THEN {value} END", type_)
        return sql.col(f"CAST(coalesce({total}, 0) AS {type_})", alias)

    return f.groupBy("session_id").agg(
        bucket(f"fee_description = {mkt}", with_tax, TAX_SUM, "marketing_fees_w_tax"),
        bucket(f"fee_description = {cash}", "fee_settlement", AMOUNT_SUM, "cash_advance_w_tax"),
        bucket(f"fee_description NOT IN ({mkt}, {cash})", other, TAX_SUM, "other_fees_w_tax"),
    )


# -- partner view -----------------------------------------------------------------
#
# A session is attributed to every partner that sold in it. The source joins the
# fee table to the (session, partner) pairs twice, so with k partners in a
# session each partner receives k times the session's fees. ``pairs`` carries k,
# so the repetition is one multiplication instead of a k*k fan-out.

PARTNER_FEE_BUCKETS = (
    # fee type, column prefix, taxable
    (S.FEE_MARKETING, "marketing", True),
    (S.FEE_CASH_ADVANCE, "cash_advance", False),
    (S.FEE_SPONSORSHIP, "sponsorship", True),
    (S.FEE_RECONCILIATION, "reconciliation", True),
    (S.FEE_OTHER, "other", True),
)
SETTLEMENT_FEE_MEASURES = [f"{p}_{s}" for _, p, _ in PARTNER_FEE_BUCKETS for s in ("fees", "tax")]
PARTNER_FEE_MEASURES = ["invoice_marketing_fees", *SETTLEMENT_FEE_MEASURES]


def partner_session_fee_totals(fees: DataFrame, rates: DataFrame,
                               session_ids: DataFrame | None = None) -> DataFrame:
    """Per session: the invoice-side marketing fee (A6) and, for each of the five
    fee types, the settlement fee and its tax (A7); types outside the five are not
    counted, tax only when apply_tax is TRUE (NULL is not taxed), cash advances
    never. One aggregation of the fee table, to be multiplied by the session's
    partner count."""
    f = attach_rates(_session_fees(fees, session_ids), rates, "fee_description")
    marketing = sql.sum_as(
        f"CASE WHEN fee_type = {sql.lit(S.FEE_MARKETING)} THEN fee_invoice END", AMOUNT_SUM)
    aggs = [sql.col(f"CAST(coalesce({marketing}, 0) AS {AMOUNT_SUM})", "invoice_marketing_fees")]
    for type_, prefix, taxable in PARTNER_FEE_BUCKETS:
        is_type = f"fee_type = {sql.lit(type_)}"
        aggs.append(sql.col(sql.sum_as(f"CASE WHEN {is_type} THEN fee_settlement ELSE 0 END",
                                       AMOUNT_SUM), f"{prefix}_fees"))
        tax = (f"CASE WHEN {is_type} AND apply_tax = true THEN fee_settlement * tax_rate ELSE 0 END"
               if taxable else "0")
        aggs.append(sql.col(sql.sum_as(tax, TAX_SUM), f"{prefix}_tax"))
    return f.groupBy("session_id").agg(*aggs)


def attributed(measures: list[str]) -> list[Column]:
    """Per partner: the sums of session fees times ``k``, the session's partners."""
    return [sql.col(sql.sum_as(f"{m} * k", TAX_SUM if m.endswith("_tax") else AMOUNT_SUM), m)
            for m in measures]


def with_partner_count(pairs: DataFrame) -> DataFrame:
    """``pairs`` (one row per session and partner, a NULL partner included) with
    ``k``. The window is bounded by the partners of one session."""
    return pairs.withColumn("k", F.count(F.lit(1)).over(
        Window.partitionBy("session_id")).cast("int"))


def _partner_fees(fees: DataFrame, pairs: DataFrame, rates: DataFrame,
                  measures: list[str]) -> DataFrame:
    sold = pairs.select("session_id", "partner_id").distinct()
    joined = with_partner_count(sold).join(partner_session_fee_totals(fees, rates), "session_id")
    return joined.groupBy("partner_id").agg(*attributed(measures))


def partner_marketing_fees(fees: DataFrame, pairs: DataFrame, rates: DataFrame) -> DataFrame:
    """A6: partner -> ``invoice_marketing_fees`` (invoice amount, by fee type).
    ``pairs`` has session_id and partner_id: the sales lines or any aggregate."""
    return _partner_fees(fees, pairs, rates, ["invoice_marketing_fees"])


def partner_settlement_fees(fees: DataFrame, pairs: DataFrame, rates: DataFrame) -> DataFrame:
    """A7: partner -> settlement fee and its tax for each of the five fee types."""
    return _partner_fees(fees, pairs, rates, SETTLEMENT_FEE_MEASURES)
