"""Logical schemas of the four input tables.

The source system declares none; these are inferred from how each column is
used by the reports. Money is DECIMAL so sums are exact and order independent.
"""

from pyspark.sql import types as T

MONEY_12_2 = T.DecimalType(12, 2)
MONEY_18_4 = T.DecimalType(18, 4)
MONEY_17_4 = T.DecimalType(17, 4)
MONEY_23_6 = T.DecimalType(23, 6)
MONEY_16_4 = T.DecimalType(16, 4)
RATE_PCT = T.DecimalType(9, 4)

# The item status and fee category vocabularies of the source data.
STATUS_VALIDATED = "validated/expired"
STATUS_CANCELED = "canceled"
STATUS_PURCHASED = "purchased"

FEE_MARKETING = "Marketing"
FEE_CASH_ADVANCE = "Cash advance"
FEE_SPONSORSHIP = "Sponsorship"
FEE_RECONCILIATION = "Reconciliation"
FEE_OTHER = "Other"
FEE_TYPES = (FEE_MARKETING, FEE_CASH_ADVANCE, FEE_SPONSORSHIP, FEE_RECONCILIATION, FEE_OTHER)

TAX_DEFAULT_KEY = "default"

SALES_LINES = T.StructType([
    T.StructField("session_id", T.LongType()),
    T.StructField("partner_raw", T.StringType()),
    T.StructField("contract_code", T.StringType()),
    T.StructField("invoice_id", T.LongType()),
    T.StructField("period_from", T.DateType()),
    T.StructField("period_to", T.DateType()),
    T.StructField("input_date", T.DateType()),
    T.StructField("invoice_link", T.StringType()),
    T.StructField("settlement_link", T.StringType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("item_status", T.StringType()),
    T.StructField("plan_id", T.LongType()),
    T.StructField("gross_amount", MONEY_12_2),
    T.StructField("collected_amount", MONEY_18_4),
    T.StructField("commission", MONEY_17_4),
    T.StructField("cancel_fee", MONEY_17_4),
    T.StructField("commission_w_tax", MONEY_23_6),
])

TAXES = T.StructType([
    T.StructField("session_id", T.LongType()),
    T.StructField("applies_to", T.StringType()),
    T.StructField("rate_pct", RATE_PCT),
])

FEES = T.StructType([
    T.StructField("session_id", T.LongType()),
    T.StructField("contract_code", T.StringType()),
    T.StructField("fee_type", T.StringType()),
    T.StructField("fee_description", T.StringType()),
    T.StructField("fee_invoice", MONEY_16_4),
    T.StructField("fee_settlement", MONEY_16_4),
    T.StructField("apply_tax", T.BooleanType()),
])

ACCOUNTS = T.StructType([
    T.StructField("partner_code", T.StringType()),
    T.StructField("name", T.StringType()),
])
