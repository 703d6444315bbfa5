"""Skew: a hot (item, status) group and a block of NULL items.

With broadcasts disabled the item join must sort-merge, and AQE has to split
the skewed partitions; results are checked against closed forms (the literal
self-join would need 64 million joined rows here).
"""

from __future__ import annotations

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from conftest import make_tables, sale

from ledgerlens.operators.items import consolidated_items, item_history
from ledgerlens.plans.invoice import invoice_summary
from ledgerlens.plans.settlement import settlement_detail

HOT, DISTINCT, NULLS = 8000, 2000, 4000

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skewed(spark):
    saved = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in saved.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


CW = D("1.500000")


def hot_sales(spark):
    rows = ([sale(item_id=1, gross_amount=D("100"), collected_amount=D("90"),
                  commission_w_tax=CW) for _ in range(HOT)]
            + [sale(item_id=10 + i, gross_amount=D("100"), collected_amount=D("90"),
                    commission_w_tax=CW) for i in range(DISTINCT)]
            + [sale(item_id=None, commission_w_tax=CW) for _ in range(NULLS)])
    t = make_tables(spark, sales=rows)
    return t.with_sales(t.sales.repartition(8))


def test_hot_item_and_null_items_settle_exactly(skewed):
    (r,) = settlement_detail(hot_sales(skewed)).collect()
    # each hot line joins all HOT lines of its (item, status): HOT x (HOT x 100)
    assert r.gross_revenue == HOT * HOT * 100 + DISTINCT * 100
    assert r.collected_revenue == HOT * HOT * 90 + DISTINCT * 90
    # NULL-item lines count once, the hot lines HOT times each
    assert r.executed_commission_w_tax == (HOT * HOT + DISTINCT + NULLS) * CW


def test_hot_item_lines_are_split(skewed):
    df = consolidated_items(hot_sales(skewed).sales)
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == HOT + DISTINCT + NULLS
    assert sum(r.gross_transaction for r in rows) == 100 * len(rows)
    # both sides come from a shuffle, so AQE may split the hot item
    assert "SortMergeJoin(skew=true)" in plan, plan[:3000]


def test_rows_of_one_input_date_sort_in_several_tasks(skewed):
    rows = [sale(session_id=i, invoice_id=i, input_date=None) for i in range(3000)]
    t = make_tables(skewed, sales=rows)
    df = invoice_summary(t.with_sales(t.sales.repartition(8)))
    tasks = [r["task"] for r in df.select(F.spark_partition_id().alias("task")).collect()]
    assert len(set(tasks)) >= 4 and max(tasks.count(x) for x in set(tasks)) < 1500
    assert df.first().invoice_id == "TOTAL"


def test_hot_item_history(spark):
    rows = ([sale(item_id=1, gross_amount=D(g)) for g in ("5", "7", "3")] * 2000
            + [sale(item_id=1, item_status="canceled", gross_amount=D("1"))])
    (h,) = item_history(make_tables(spark, sales=rows).sales).collect()
    assert h.hist_gross == D("-7")
