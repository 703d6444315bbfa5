"""Lines stored by item against the join of the plain history."""

from __future__ import annotations

import itertools

import pytest

from conftest import make_tables, sale
from test_random_oracle import random_tables

from ledgerlens.operators.filters import RunFilter
from ledgerlens.operators.items import consolidated_items
from ledgerlens.session import scratch_dir
from ledgerlens.sources.by_item import SalesByItem


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("part_rows", [3, 1000])
def test_equal_to_the_plain_join(spark, part_rows):
    """With items of several parts (3 lines a part) and without."""
    sales = make_tables(spark, random_tables(5)["sales_lines"]).sales
    copy = SalesByItem(spark, scratch_dir(spark, "by-item"), buckets=4, part_rows=part_rows)
    copy.write(sales)
    assert (copy.lines().agg({"item_parts": "max"}).first()[0] > 1) == (part_rows == 3)
    assert rows(copy.consolidated_items()) == rows(consolidated_items(sales))
    for run in (RunFilter(partner_id=1000), RunFilter(contract_code="C2")):
        assert rows(copy.consolidated_items(run)) == rows(consolidated_items(run.apply(sales)))
    more = sales.unionByName(sales)
    copy.write(more)
    again = SalesByItem(spark.newSession(), copy.root)
    assert rows(again.consolidated_items()) == rows(consolidated_items(more))


def test_lines_and_history_meet_without_a_shuffle(spark):
    """Item 1 has a third of the lines: they are in several buckets."""
    lines = [sale(item_id=1 if i % 3 == 0 else 10 + i, invoice_id=i) for i in range(900)]
    copy = SalesByItem(spark, scratch_dir(spark, "by-item"), buckets=8, part_rows=50)
    copy.write(make_tables(spark, lines).sales)
    plan = copy.consolidated_items()._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()

    def depth(line: str) -> int:
        return len(line) - len(line.lstrip(" :+-"))

    at = next(i for i, x in enumerate(lines) if "SortMergeJoin [item_id" in x)
    under = list(itertools.takewhile(lambda x: depth(x) > depth(lines[at]), lines[at + 1:]))
    assert len([x for x in under if "Bucketed: true" in x]) == 2
    assert not any("Exchange" in x for x in under)
    held = (copy.lines().where("item_id = 1").selectExpr("input_file_name() AS f").distinct())
    assert held.count() >= 3


def test_items_of_several_parts_meet_without_a_shuffle_of_the_lines(spark):
    """What such items' lines meet is stored, so that its size is known: the join with it
    moves no line although no table of lines may be broadcast."""
    lines = [sale(item_id=1 if i % 3 == 0 else 10 + i, invoice_id=i) for i in range(900)]
    sales = make_tables(spark, lines).sales
    copy = SalesByItem(spark, scratch_dir(spark, "by-item"), buckets=8, part_rows=50)
    copy.write(sales)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4k")
    try:
        got = copy.consolidated_items()
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert rows(got) == rows(consolidated_items(sales))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
