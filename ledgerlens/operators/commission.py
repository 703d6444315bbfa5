"""Ticketing commission and the tax on it (per invoice and per partner).

The tax rate of a line depends only on (session, plan). Since the tax is
linear in the commission, the sales lines are first summed per
(group, session, plan) — a map-side partial aggregation that collapses the fact
table before anything is shuffled, hot sessions included — and only those sums
meet the tax table:

    sum(commission * rate) = sum over plans of rate(plan) * sum(commission)

which is exact in DECIMAL arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens import schemas as S
from ledgerlens.functions import sqltext as sql
from ledgerlens.functions.columns import AMOUNT_SUM, PARTIAL_MONEY, TAX_SUM
from ledgerlens.operators.taxes import attach_rates

INVOICE_KEYS = ("session_id", "invoice_id", "period_from", "period_to", "input_date",
                "invoice_link")


def commission_by_plan(base: DataFrame, keys: list[str]) -> DataFrame:
    """Commission ``m`` of validated/canceled lines summed per (keys, plan);
    ``keys`` contains ``session_id``. The map-side partial aggregation here is
    what shrinks the fact table before anything is shuffled."""
    return (
        base.where(F.expr(sql.IS_COMMISSION_LINE))
        .selectExpr(*keys, "plan_id", f"{sql.TICKET_COMMISSION} AS m")
        .groupBy(*keys, "plan_id")
        .agg(sql.col(sql.sum_as("m", PARTIAL_MONEY), "m"))
    )


def rate_plans(by_plan: DataFrame, rates: DataFrame) -> DataFrame:
    """Attach the resolved tax rate of each (session, plan)."""
    return attach_rates(by_plan, rates, "CAST(plan_id AS STRING)")


def commission_totals(rated: DataFrame, keys: list[str]) -> DataFrame:
    return rated.groupBy(*keys).agg(
        sql.col(sql.sum_as("m", AMOUNT_SUM), "commission"),
        sql.col(sql.sum_as("m * tax_rate", TAX_SUM), "commission_tax"),
    )


def commission_by_invoice(base: DataFrame, rates: DataFrame) -> DataFrame:
    """A4: (session, invoice id as text, period, input date, link) -> commission, tax."""
    keyed = base.withColumn("invoice_id", F.col("invoice_id").cast("string"))
    keys = list(INVOICE_KEYS)
    return commission_totals(rate_plans(commission_by_plan(keyed, keys), rates), keys)


# -- partner view: one aggregate of the lines serves A5, A10 and the report ---------

def partner_grain(base: DataFrame) -> DataFrame:
    """(partner, session, plan) -> ``lines`` with a commission, their commission ``m``,
    and ``own``: the collected amount of the lines that are not canceled (purchased
    and unknown ones count 0). ``base`` has ``partner_id``."""
    own = (f"CASE WHEN NOT (item_status <=> {sql.lit(S.STATUS_CANCELED)}) THEN "
           f"CASE WHEN item_status != {sql.lit(S.STATUS_PURCHASED)} THEN collected_amount "
           f"ELSE 0 END END")
    return base.groupBy("partner_id", "session_id", "plan_id").agg(
        sql.col(f"count(CASE WHEN {sql.IS_COMMISSION_LINE} THEN 1 END)", "lines"),
        sql.col(sql.sum_as(f"CASE WHEN {sql.IS_COMMISSION_LINE} THEN {sql.TICKET_COMMISSION} END",
                           PARTIAL_MONEY), "m"),
        sql.col(sql.sum_as(own, AMOUNT_SUM), "own"))


def partner_pairs(grain: DataFrame, rates: DataFrame) -> DataFrame:
    """(session, partner) -> the sums of :func:`partner_grain`, the commission with
    its tax."""
    return rate_plans(grain, rates).groupBy("session_id", "partner_id").agg(
        F.sum("lines").alias("lines"),
        sql.col(sql.sum_as("m", AMOUNT_SUM), "commission"),
        sql.col(sql.sum_as("m * tax_rate", TAX_SUM), "commission_tax"),
        sql.col(sql.sum_as("own", AMOUNT_SUM), "own"))


PARTNER_TOTALS = {"lines": "bigint", "commission": AMOUNT_SUM, "commission_tax": TAX_SUM,
                  "own": AMOUNT_SUM}


def partner_totals(pairs: DataFrame, *more: Column) -> DataFrame:
    """partner -> the sums of :func:`partner_pairs`, and ``more`` aggregates."""
    return pairs.groupBy("partner_id").agg(
        *[sql.col(sql.sum_as(c, t), c) for c, t in PARTNER_TOTALS.items()], *more)


def partner_commission(base: DataFrame, rates: DataFrame) -> DataFrame:
    """A5: partner -> ticketing commission and its tax, of partners with any."""
    totals = partner_totals(partner_pairs(partner_grain(base), rates))
    return totals.where("lines > 0").select("partner_id", "commission", "commission_tax")
