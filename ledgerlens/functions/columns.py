"""Column expressions shared by the operators (all built-in, codegen-friendly)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tax rates are summed percentages; as a fraction they carry 6 decimals.
# Multiplying by a decimal 0.01 (not dividing by 100) keeps the result DECIMAL
# and exact: decimal(10,4) * decimal(2,2) -> decimal(13,6).
RATE_SUM_TYPE = "decimal(10,4)"
PERCENT = Decimal("0.01")
# Partial sums of a money column are narrowed to this before they are multiplied
# by a rate, so the product stays inside 38 digits with all 10 decimals.
PARTIAL_MONEY = "decimal(24,4)"
# Result types of report sums. Sums are narrowed to these so that adding two
# of them never passes 38 digits (where Spark would start dropping decimals).
AMOUNT_SUM = "decimal(28,4)"
TAX_SUM = "decimal(30,10)"
TAXED_AMOUNT_SUM = "decimal(30,6)"
# Report formulas add and subtract up to seven sums of different scales; each
# step is narrowed back to this type so no step passes 38 digits (see sqltext.add).
FORMULA = "decimal(34,10)"


def sum_as(col, type_: str) -> Column:
    """SUM of a decimal narrowed to a fixed result type (ANSI: overflow fails)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c).cast(type_)


def partner_id(raw: str = "partner_raw") -> Column:
    """Normalized partner id: thousands commas removed, cast to BIGINT.

    Under ANSI mode a value that is not an integer fails the run, as in the
    source system.
    """
    return F.replace(F.col(raw), F.lit(","), F.lit("")).cast("long")


def with_partner_id(sales: DataFrame) -> DataFrame:
    """Add ``partner_id`` unless the table already stores it."""
    if "partner_id" in sales.columns:
        return sales
    return sales.withColumn("partner_id", partner_id())


def money_to_double(df: DataFrame) -> DataFrame:
    """Cast every DECIMAL column to DOUBLE (presentation for engine-neutral checks)."""
    from pyspark.sql.types import DecimalType

    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
        else F.col(f.name)
        for f in df.schema.fields
    ])
