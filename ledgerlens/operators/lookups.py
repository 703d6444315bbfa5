"""Key lookups over the sales history and the accounts table.

Single-key lookups return a DataFrame of at most one row (the list lookup: all
contracts, or the first ``limit`` for a caller that asks). "Latest" means greatest ``period_to`` with NULL
dates last; ties, left open by the source system, are broken deterministically
by the returned value, greatest first. ``orderBy(...).limit(n)`` plans as a
TakeOrderedAndProject: every task keeps its own top n, nothing is sorted globally.

The bulk forms answer the lookup for every key at once: first the latest date
per (key, value), a hash aggregation with a fixed-width buffer that collapses
the history map-side (a key holding a third of all rows costs no more than any
other), then ``max(struct(period_to, value))`` per key over those few pairs.
Struct ordering puts NULL fields first, which is exactly "NULL dates last" for
a max.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import with_partner_id


def _latest(df: DataFrame, value: str) -> DataFrame:
    return (df.select(value, "period_to")
            .orderBy(F.col("period_to").desc_nulls_last(), F.col(value).desc_nulls_last())
            .limit(1)
            .select(value))


def partner_for_contract(sales: DataFrame, contract_code: str) -> DataFrame:
    """L1: the partner (as spelt in the data) of the latest line of a contract."""
    return _latest(sales.where(F.col("contract_code") == F.lit(contract_code)), "partner_raw")


def contract_for_partner(sales: DataFrame, partner_id: int) -> DataFrame:
    """L2: the latest non-NULL contract of a partner (matched after comma removal)."""
    base = with_partner_id(sales)
    return _latest(base.where((F.col("partner_id") == F.lit(int(partner_id)))
                              & F.col("contract_code").isNotNull()), "contract_code")


def contracts_of_partner(sales: DataFrame, partner_id: int,
                         limit: int | None = None) -> DataFrame:
    """L3: distinct non-NULL contracts of a partner, ascending."""
    base = with_partner_id(sales)
    found = (base.where((F.col("partner_id") == F.lit(int(partner_id)))
                        & F.col("contract_code").isNotNull())
             .select("contract_code").distinct().orderBy("contract_code"))
    return found if limit is None else found.limit(limit)


def account_name(accounts: DataFrame, partner_id: int) -> DataFrame:
    """L4: the account name of a partner code (cast to BIGINT, no comma handling;
    ANSI: a non-numeric code fails). First name in order when several match."""
    return (accounts.where(F.col("partner_code").cast("long") == F.lit(int(partner_id)))
            .select("name").orderBy(F.col("name").asc_nulls_last()).limit(1))


def _latest_per_key(df: DataFrame, key: str, value: str) -> DataFrame:
    return (df.where(F.col(key).isNotNull())
            .groupBy(key, value).agg(F.max("period_to").alias("period_to"))
            .groupBy(key).agg(F.max(F.struct("period_to", value)).alias("_top"))
            .select(key, F.col(f"_top.{value}").alias(value)))


def latest_partner_by_contract(sales: DataFrame) -> DataFrame:
    """L1 for every contract: contract_code -> partner_raw."""
    return _latest_per_key(sales, "contract_code", "partner_raw")


def latest_contract_by_partner(sales: DataFrame) -> DataFrame:
    """L2 for every partner: partner_id -> latest non-NULL contract_code."""
    base = with_partner_id(sales).where(F.col("contract_code").isNotNull())
    return _latest_per_key(base, "partner_id", "contract_code")
