"""Settlement lines of a large history: counted by item, sent once if no item is hot."""

from __future__ import annotations

from decimal import Decimal as D

import pytest

from conftest import make_tables, sale
from test_plans import final_plan
from test_random_oracle import random_tables

from ledgerlens.operators import items as I
from ledgerlens.operators.filters import RunFilter
from ledgerlens.plans.settlement import settlement_detail


@pytest.fixture
def large(monkeypatch):
    """Every history is large enough to be counted."""
    monkeypatch.setattr(I, "COUNTED_BYTES", 0)


def shuffles(df) -> int:
    return final_plan(df).count("Exchange hashpartitioning")


def rows(df) -> list:
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_are_sent_once_and_settle_alike(spark, large, seed):
    lines = random_tables(seed)["sales_lines"]
    lines += [sale(item_id=5, item_status=s, gross_amount=a, collected_amount=a)
              for s in ("canceled", "purchased", "other", None) for a in (None, D("3"), D("3"))]
    lines += [sale(item_id=None, item_status=s, commission_w_tax=None)
              for s in ("canceled", "purchased", None)]
    sales = make_tables(spark, lines).sales
    dealt, summed = I.settlement_lines(sales), I.settlement_lines(sales, counted=False)
    assert dealt.schema == summed.schema and rows(dealt) == rows(summed)
    assert (shuffles(dealt), shuffles(summed)) == (2, 3)


@pytest.mark.parametrize("item", [7, None])
def test_lines_of_a_hot_item_are_summed_first(spark, large, monkeypatch, item):
    monkeypatch.setattr(I, "HOT_LINES", 50)
    cool = [sale() for _ in range(60)]
    assert not I.has_hot_item(make_tables(spark, cool).sales)
    sales = make_tables(spark, cool + [sale(item_id=item) for _ in range(51)]).sales
    assert I.has_hot_item(sales)
    assert shuffles(I.settlement_lines(sales)) == 3


def test_a_whole_run_counts_and_a_filtered_one_does_not(spark, large, monkeypatch):
    counted, real = [], I.has_hot_item
    monkeypatch.setattr(I, "has_hot_item", lambda base: counted.append(1) or real(base))
    t = make_tables(spark, [sale(item_id=i // 2, settlement_link=f"set/{i % 3}")
                            for i in range(30)])
    settlement_detail(t, RunFilter(partner_id=1000)).collect()
    assert not counted
    got = rows(settlement_detail(t))
    assert counted
    monkeypatch.setattr(I, "COUNTED_BYTES", 1)
    assert got == rows(settlement_detail(t))


@pytest.mark.parametrize("most", [1, 10_000])
def test_only_lines_of_hot_items_are_summed_first(spark, large, monkeypatch, most):
    """Items 1 and 2 are hot, and session 1 by its lines without an item; ``most`` 1: too
    many hot bins to be listed, so every line is summed."""
    monkeypatch.setattr(I, "HOT_LINES", 50)
    monkeypatch.setattr(I, "MOST_HOT_BINS", most)
    lines = [sale(item_id=i, item_status=("canceled", "purchased", None)[k % 3],
                  invoice_id=k % 2, gross_amount=None if k % 4 else D(k))
             for i in (1, 2, None) for k in range(60)]
    lines += [sale(item_id=None, session_id=2, commission_w_tax=None) for _ in range(5)]
    lines += [sale(item_id=100 + k // 2, item_status=("canceled", "other")[k % 2],
                   collected_amount=None if k % 5 else D(k)) for k in range(40)]
    sales = make_tables(spark, lines).sales
    seen, real = [], I.item_status_rows
    monkeypatch.setattr(I, "item_status_rows", lambda base: seen.append(base) or real(base))
    got = I.settlement_lines(sales)
    assert len(seen) == 1 and seen[0].count() == (180 if most > 1 else len(lines))
    want = I.settlement_lines(sales, counted=False)
    assert got.schema == want.schema and rows(got) == rows(want)
    assert shuffles(got) == 3


@pytest.mark.parametrize("without_item,counts", [(10, 1), (51, 2)])
def test_sessions_are_counted_only_if_many_lines_are_without_an_item(
        spark, monkeypatch, without_item, counts):
    monkeypatch.setattr(I, "HOT_LINES", 50)
    lines = [sale() for _ in range(60)]
    lines += [sale(item_id=None, session_id=k) for k in range(without_item)]
    sales = make_tables(spark, lines).sales
    read, real = [], type(sales).groupBy
    monkeypatch.setattr(type(sales), "groupBy", lambda df, *c: read.append(1) or real(df, *c))
    assert not I.has_hot_item(sales)
    assert len(read) == counts
