"""Operator 4: the schedule's guarantees, and places against plain Python and SQL."""

import hashlib
from fractions import Fraction

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlens.llm import op4_mix as M
from tests.llm.conftest import documents

SF001 = "/root/testdata/sf0.01"


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=9))
def test_deviation_stays_under_a_block(weights):
    shares = {f"s{i}": w for i, w in enumerate(weights)}
    q = sum(weights)
    placed = M.period(shares)
    assert [t for _, _, t in placed] == list(range(q))
    had = dict.fromkeys(shares, 0)
    for pool, j, t in placed:
        release, deadline = M.window_of(j, shares[pool], q)
        assert had[pool] == j and release <= t < deadline
        had[pool] += 1
        for p, w in shares.items():
            assert abs(had[p] - Fraction((t + 1) * w, q)) < 1
    assert had == shares


def test_bad_weights_are_refused():
    with pytest.raises(ValueError):
        M.period({"a": 0, "b": 3})
    with pytest.raises(ValueError):
        M.period({"a": M.MOST_SHARES, "b": 1})


def slow_places(docs, weights, other, block):
    """doc_id -> place, by running the schedule slot by slot."""
    pools = {}
    for i, source in docs:
        pools.setdefault(source if source in weights else M.OTHER, []).append(i)
    for ids in pools.values():
        ids.sort(key=lambda i: (hashlib.md5(str(i).encode()).hexdigest(), i))
    shares = {p: weights.get(p, other) for p in pools}
    q, done, out, slot = sum(shares.values()), dict.fromkeys(sorted(pools), 0), {}, 0
    while len(out) < len(docs):
        ready = [(-(-(j + 1) * q // shares[p]), p) for p, j in done.items()
                 if j * q // shares[p] <= slot]
        pool = min(ready)[1]
        for k, i in enumerate(pools[pool][done[pool] * block:(done[pool] + 1) * block]):
            out[i] = slot * block + k
        done[pool] += 1
        slot += 1
    return out


@pytest.mark.parametrize("block,bucket", [(1, 50_000), (8, 50_000), (3, 2)])
def test_places(spark, monkeypatch, block, bucket):
    monkeypatch.setattr(M, "BUCKET_ROWS", bucket)
    docs = [(i, "x", "en", "big" if i % 3 else f"s{i % 5}") for i in range(300)]
    weights = {"big": 2, "s0": 3, "s1": 1}
    got = M.mix(documents(spark, docs), weights, 2, block).collect()
    assert {r["doc_id"]: r["place"] for r in got} == slow_places(
        [(d[0], d[3]) for d in docs], weights, 2, block)
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in got)


def test_balanced_prefix_has_the_weights(spark):
    rows = M.op4_mix(spark, SF001).where("balanced").collect()
    end = max(r["slot"] for r in rows) + 1
    q = sum(w for w in M.WEIGHTS.values())
    for pool in M.WEIGHTS:
        blocks = len({r["block_no"] for r in rows if r["pool"] == pool})
        assert abs(blocks - Fraction(end * M.WEIGHTS[pool], q)) < 1


def test_edges(spark):
    docs = documents(spark, [(1, "a", "en", None), (None, "b", "en", "a"), (2, None, "en", "a"),
                             (2, None, "en", "a"), (3, "", "en", "")])
    docs = docs.withColumn("slot", F.lit("old")).withColumn("_md5", F.lit("x")).withColumn(
        "_entry", F.lit("kept"))
    got = M.mix(docs, {"a": 3}, 1, 2)
    assert {r["_entry"] for r in got.collect()} == {"kept"}
    assert got.count() == 5 and got.columns.count("slot") == 1 and "_md5" in got.columns
    assert len({r["place"] for r in got.collect()}) == 5
    assert {r["pool"] for r in got.collect()} == {"a", M.OTHER}
    assert M.mix(docs.where("false"), {"a": 3}).count() == 0


def test_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF001}/documents.parquet'")
    rel = con.sql(M.OP4_SQL)
    got = M.op4_mix(spark, SF001).select(rel.columns).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, rel.fetchall()))
