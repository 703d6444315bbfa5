"""The settlement state after any sequence of days against the full run over them."""

from __future__ import annotations

import random

import pytest

from conftest import make_tables, sale
from test_random_oracle import random_tables

from ledgerlens.operators.daily import SettlementState
from ledgerlens.operators.items import item_history, settlement_lines
from ledgerlens.session import scratch_dir


def sales(spark, rows):
    return make_tables(spark, rows).sales


def same(state, spark, days):
    """State and full run agree, column by column."""
    whole = sales(spark, [r for rows in days.values() for r in rows])
    for got, want in ((state.settlement_lines(), settlement_lines(whole)),
                      (state.item_history(), item_history(whole))):
        assert sorted(map(tuple, got.select(want.columns).collect()), key=str) == \
            sorted(map(tuple, want.collect()), key=str)


@pytest.mark.parametrize("seed", [1])
def test_days_loaded_and_loaded_again(spark, seed):
    rng = random.Random(seed)
    rows = random_tables(seed)["sales_lines"]
    days = {f"2024-01-0{d}": [r for i, r in enumerate(rows) if i % 4 == d] for d in range(4)}
    state = SettlementState(spark, scratch_dir(spark, "state"), buckets=4, keep=3)
    done = {}
    for day, part in days.items():
        state.ingest(day, sales(spark, part))
        done[day] = part
    same(state, spark, done)
    state.ingest("2024-01-01", sales(spark, days["2024-01-01"]))  # unchanged
    same(state, spark, done)
    # with other lines than before, some of them of other items and groups, after a merge
    done["2024-01-02"] = rng.sample(rows, 20)
    state.ingest("2024-01-02", sales(spark, done["2024-01-02"]))
    same(state, spark, done)
    assert len(state.at["lines"]) <= 4


def test_a_replaced_day_takes_its_groups_with_it(spark):
    a, b = sale(item_id=1), sale(item_id=2, settlement_link="set/99", session_id=7)
    state = SettlementState(spark, scratch_dir(spark, "state"), buckets=4)
    state.ingest("1", sales(spark, [a]))
    state.ingest("2", sales(spark, [b, sale(item_id=None, settlement_link="set/98")]))
    state.ingest("2", sales(spark, []))
    same(state, spark, {"1": [a]})


def test_a_failed_load_changes_nothing_and_another_session_goes_on(spark, monkeypatch):
    lines = [sale(item_id=5), sale(item_id=5, item_status="canceled"), sale(item_id=None)]
    state = SettlementState(spark, scratch_dir(spark, "state"), buckets=4)
    state.ingest("1", sales(spark, lines))

    def broken(changes):
        raise OSError("midway")

    monkeypatch.setattr(state, "_summed", broken)
    with pytest.raises(OSError):
        state.ingest("2", sales(spark, [sale(item_id=5)]))
    # another session: its catalog knows none of the state's tables
    other = SettlementState(spark.newSession(), state.root)
    for table in other.at["lines"]:
        spark.sql(f"DROP TABLE {table['name']}")
    same(other, spark, {"1": lines})
    more = [sale(item_id=5, collected_amount=None, gross_amount=None), sale(item_id=6)]
    other.ingest("2", sales(other.spark, more))
    same(other, spark, {"1": lines, "2": more})


def test_the_past_is_read_by_bucket(spark):
    """No shuffle under the join of a day's items with the past, and none of the past
    for the item maxima until they are one row an item and table."""
    state = SettlementState(spark, scratch_dir(spark, "state"), buckets=4)
    state.ingest("1", sales(spark, [sale(item_id=i) for i in range(50)]))
    items = spark.createDataFrame([(3,), (4,)], "bucket long").hint("merge")
    plan = state._past(items)._jdf.queryExecution().executedPlan().toString()
    join = plan[plan.index("SortMergeJoin"):]
    assert "LeftSemi" in join and "Bucketed: true" in join
    past = join[:join.index("Scan parquet")]
    assert "Exchange" not in past
    maxima = state.item_history()._jdf.queryExecution().executedPlan().toString()
    assert maxima.count("Exchange") == 1


def test_only_touched_items_are_computed(spark):
    state = SettlementState(spark, scratch_dir(spark, "state"), buckets=4)
    state.ingest("1", sales(spark, [sale(item_id=i) for i in range(200)]))
    state.ingest("2", sales(spark, [sale(item_id=7)]))
    seen = []
    measures = state._measures
    state._measures = lambda rows, sign: (seen.append((sign, rows.select("item_id").distinct()
                                                       .count())), measures(rows, sign))[1]
    state.ingest("3", sales(spark, [sale(item_id=7), sale(item_id=8)]))
    assert sorted(seen) == [(-1, 2), (1, 2)]


def test_days_meet_in_their_buckets(spark, monkeypatch):
    """Whatever a load computes before its differences are summed by group stays where
    the buckets lie, also with several tables and a day loaded again."""
    state = SettlementState(spark, scratch_dir(spark, "state"), buckets=4)
    plans, summed = [], state._summed

    def seen(changes):
        plans.append(changes._jdf.queryExecution().executedPlan().toString())
        return summed(changes)

    monkeypatch.setattr(state, "_summed", seen)
    days = {d: [sale(item_id=i) for i in range(20 * int(d), 40 + 20 * int(d))] + [
        sale(item_id=None), sale(item_id=21, item_status="canceled")] for d in "123"}
    for day in ("1", "2", "3", "2"):
        state.ingest(day, sales(spark, days[day]))
    assert len(plans) == 4 and not any("Exchange hashpartitioning" in p for p in plans)
    # a day that is loaded again as it was changes no group
    assert spark.read.parquet(state.at["groups"][-1]).count() == 0
    same(state, spark, days)
    maxima = state.item_history()._jdf.queryExecution().executedPlan().toString()
    assert maxima.split("Exchange")[0].count("Scan parquet") == 4


def test_a_hot_item_collapses_before_it_is_dealt(spark):
    """An item, or the lines without one, over ``hot_lines``: summed first."""
    few = [sale(item_id=i) for i in range(9)]
    state = SettlementState(spark, scratch_dir(spark, "state"), buckets=4, hot_lines=5)

    def dealt(rows):
        plan = state._rows(sales(spark, rows))._jdf.queryExecution().executedPlan().toString()
        return plan.index("HashAggregate") > plan.index("REPARTITION_BY_NUM")

    hot = [sale(item_id=3, item_status="canceled") for _ in range(6)]
    none = [sale(item_id=None) for _ in range(6)]
    assert dealt(few + hot) and dealt(few + none) and not dealt(few)
    state.ingest("1", sales(spark, few + hot))
    state.ingest("2", sales(spark, few + none))
    same(state, spark, {"1": few + hot, "2": few + none})
