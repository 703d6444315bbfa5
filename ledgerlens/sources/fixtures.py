"""Derive the four logical input tables from the driver's TPC-H-style tables.

The test data has no sales history, taxes or fees of its own, so they are
derived, deterministically and with functions Spark and DuckDB share, from
``lineitem``, ``orders`` and ``supplier``:

* one sales line per lineitem row, joined to its order (``sales_lines``);
* a few tax rows per billing session (``taxes``);
* one fixed fee for every order that has lines (``fees``);
* one account per supplier (``accounts``).

Everything is a lazy DataFrame; the only shuffles are the lineitem/orders join,
which at scale is the ingest job that materializes ``sales_lines`` once, and the
lines counted down to one per order for the fees.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import schemas as S

# Fixed values of the derived test data (not of the audited system):
# tax rows per session as (applies_to, rate in percent, keep when session_id % m != 0).
TAX_TEMPLATE = [
    ("default", "19.0", 7),
    ("default", "2.0", 7),
    ("0", "10.0", 3),
    ("1", "5.5", 3),
    ("Marketing", "8.0", 4),
    ("Media plan", "4.0", 5),
]
# order priority -> fee type, and -> fee description when not 'Media plan' / NULL
PRIORITY_FEE_TYPE = [
    ("1-URGENT", "Marketing"),
    ("2-HIGH", "Cash advance"),
    ("3-MEDIUM", "Sponsorship"),
    ("4-NOT SPECIFIED", "Reconciliation"),
]
PRIORITY_FEE_DESCRIPTION = [
    ("1-URGENT", "Marketing"),
    ("2-HIGH", "Cash advance"),
]
RETURNFLAG_STATUS = [
    ("A", S.STATUS_VALIDATED),
    ("R", S.STATUS_CANCELED),
    ("N", S.STATUS_PURCHASED),
]
PARTNER_OFFSET = 990


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(col: Column, mapping, default=None) -> Column:
    out = None
    for key, value in mapping:
        cond = col == F.lit(key)
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    return out.otherwise(F.lit(default)) if default is not None else out


def _with_orders(lines: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lines`` (l_orderkey, l_suppkey, ...) joined to their order, with the session."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus", "o_orderpriority")
    k = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return k.withColumn("session_id", F.col("l_suppkey") * 10 + (F.year("o_orderdate") - 1995))


def _keyed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem joined to its order, with the derived keys of the sales lines."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
    year = F.year("o_orderdate")
    return (
        _with_orders(li, spark, sf_dir)
        .withColumn("q0", F.make_date(year, (F.quarter("o_orderdate") - 1) * 3 + 1, F.lit(1)))
        .withColumn("px", F.col("l_extendedprice").cast(S.MONEY_12_2))
        .withColumn("dc", F.col("l_discount").cast("decimal(4,2)"))
        .withColumn("tx", F.col("l_tax").cast("decimal(4,2)"))
    )


def _partner_text(supp: Column) -> Column:
    """Partner id as the source system spells it: thousands separated by a comma."""
    p = supp + PARTNER_OFFSET
    return F.when(
        p >= 1000,
        F.concat(F.floor(p / 1000).cast("long").cast("string"), F.lit(","),
                 F.lpad((p % 1000).cast("string"), 3, "0")),
    ).otherwise(p.cast("string"))


def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = _keyed_lines(spark, sf_dir)
    invoice_id = F.col("session_id") * 10 + F.quarter("q0")
    one = F.lit(1)
    return (
        k.withColumn("invoice_id", invoice_id)
        .select(
            F.col("session_id").cast("long"),
            _partner_text(F.col("l_suppkey")).alias("partner_raw"),
            F.when(F.col("l_partkey") % 50 == 0, F.lit(None).cast("string")).otherwise(
                F.concat(F.lit("C"), (F.col("l_suppkey") % 20).cast("string"), F.lit("-"),
                         (F.col("l_linenumber") % 3).cast("string"))).alias("contract_code"),
            F.col("invoice_id").cast("long"),
            F.col("q0").alias("period_from"),
            F.last_day(F.add_months("q0", 2)).alias("period_to"),
            F.when(F.col("invoice_id") % 13 == 0, F.lit(None).cast("date"))
            .otherwise(F.date_add("q0", 95)).alias("input_date"),
            F.concat(F.lit("inv/"), F.col("invoice_id").cast("string")).alias("invoice_link"),
            F.concat(F.lit("set/"), F.col("invoice_id").cast("string")).alias("settlement_link"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long").alias("item_id"),
            _case(F.col("l_returnflag"), RETURNFLAG_STATUS).alias("item_status"),
            (F.col("l_partkey") % 20).cast("long").alias("plan_id"),
            F.col("px").alias("gross_amount"),
            (F.col("px") * (one - F.col("dc"))).cast(S.MONEY_18_4).alias("collected_amount"),
            (F.col("px") * F.col("dc")).cast(S.MONEY_17_4).alias("commission"),
            (F.col("px") * F.col("tx")).cast(S.MONEY_17_4).alias("cancel_fee"),
            (F.col("px") * F.col("dc") * (one + F.col("tx"))).cast(S.MONEY_23_6)
            .alias("commission_w_tax"),
        )
    )


def taxes(spark: SparkSession, sf_dir: str, sales: DataFrame | None = None) -> DataFrame:
    """Tax rows for every billing session: a generator, not a join — each
    distinct session expands to the template rows it keeps."""
    sales = sales if sales is not None else sales_lines(spark, sf_dir)
    template = F.array(*[
        F.struct(F.lit(key).alias("applies_to"),
                 F.lit(Decimal(rate)).cast(S.RATE_PCT).alias("rate_pct"),
                 F.lit(m).alias("m"))
        for key, rate, m in TAX_TEMPLATE
    ])
    return (
        sales.select("session_id").where(F.col("session_id").isNotNull()).distinct()
        .select("session_id", F.explode(template).alias("t"))
        .where(F.col("session_id") % F.col("t.m") != 0)
        .select("session_id", F.col("t.applies_to").alias("applies_to"),
                F.col("t.rate_pct").alias("rate_pct"))
    )


def fees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One fee per order that has lines; session and contract are those of its first
    line (of equal line numbers, the one with the smallest supplier)."""
    first = (read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
             .agg(F.min(F.struct("l_linenumber", "l_suppkey")).alias("first"))
             .select("l_orderkey", "first.l_suppkey"))
    k = _with_orders(first, spark, sf_dir)
    total = F.col("o_totalprice").cast(S.MONEY_12_2)
    description = (
        F.when(F.col("l_orderkey") % 11 == 0, F.lit(None).cast("string"))
        .when(F.col("l_orderkey") % 3 == 0, F.lit("Media plan"))
        .otherwise(_case(F.col("o_orderpriority"), PRIORITY_FEE_DESCRIPTION, S.FEE_OTHER))
    )
    return k.select(
        F.col("session_id").cast("long"),
        F.concat(F.lit("C"), (F.col("l_suppkey") % 20).cast("string"), F.lit("-1"))
        .alias("contract_code"),
        _case(F.col("o_orderpriority"), PRIORITY_FEE_TYPE, S.FEE_OTHER).alias("fee_type"),
        description.alias("fee_description"),
        (total * F.lit(Decimal("0.01"))).cast(S.MONEY_16_4).alias("fee_invoice"),
        (total * F.lit(Decimal("0.02"))).cast(S.MONEY_16_4).alias("fee_settlement"),
        F.when(F.col("o_orderstatus") == "F", F.lit(True))
        .when(F.col("o_orderstatus") == "O", F.lit(False)).alias("apply_tax"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return sup.select(
        (F.col("s_suppkey") + PARTNER_OFFSET).cast("string").alias("partner_code"),
        F.col("s_name").alias("name"),
    )
