"""Loading: columns and types are checked; nothing is rounded or capped silently."""

from __future__ import annotations

from decimal import Decimal as D

import pytest

from conftest import fee, make_tables, sale, tax

from ledgerlens.operators.lookups import contracts_of_partner
from ledgerlens.plans.invoice import invoice_summary
from ledgerlens.session import scratch_dir
from ledgerlens.sources.catalog import TABLE_NAMES, Tables


@pytest.fixture(scope="module")
def root(spark):
    path = scratch_dir(spark, "load")
    make_tables(spark, sales=[sale()]).materialize(path)
    return path


def test_money_of_another_type_is_exact_or_raises(spark, root):
    t = Tables.from_parquet(spark, root)
    for column, kind in (("gross_amount", "decimal(20,6)"), ("commission", "decimal(20,8)"),
                         ("collected_amount", "double"), ("period_to", "string")):
        wide = t.sales.withColumn(column, t.sales[column].cast(kind))
        with pytest.raises(ValueError, match=column):
            t.with_sales(wide)
    narrow = t.sales.withColumn("commission", t.sales["commission"].cast("decimal(9,1)")) \
        .withColumn("plan_id", t.sales["plan_id"].cast("int"))
    assert t.with_sales(narrow).sales.schema["commission"].dataType.simpleString() == "decimal(17,4)"
    rows = invoice_summary(t.with_sales(narrow)).collect()
    assert [r.commission for r in rows] == [D(10), D(10)]


def test_missing_columns_raise(spark, root):
    t = Tables.from_parquet(spark, root)
    with pytest.raises(ValueError, match="input_date: .*no such column"):
        t.with_sales(t.sales.drop("input_date"))


def test_all_contracts_of_a_partner(spark):
    n = 5_200
    t = make_tables(spark, sales=[sale(contract_code=f"C{i:05}") for i in range(n)])
    found = [r.contract_code for r in contracts_of_partner(t.sales, 1000).collect()]
    assert found == [f"C{i:05}" for i in range(n)]
    assert contracts_of_partner(t.sales, 1000, limit=3).count() == 3


def test_tables_from_the_catalog(spark):
    """The form nearest to a warehouse: four named tables, checked like any others."""
    from ledgerlens.plans.partner import partner_summary

    t = make_tables(spark, sales=[sale(), sale(partner_raw="2")], taxes=[tax()], fees=[fee()])
    frames = dict(zip(TABLE_NAMES, (t.sales, t.taxes, t.fees, t.accounts)))
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    try:
        found = Tables.from_catalog(spark)
        assert partner_summary(found).collect() == partner_summary(t).collect()
        t.taxes.drop("rate_pct").createOrReplaceTempView("taxes")
        with pytest.raises(ValueError, match="table taxes: rate_pct"):
            Tables.from_catalog(spark)
    finally:
        for name in frames:
            spark.catalog.dropTempView(name)
