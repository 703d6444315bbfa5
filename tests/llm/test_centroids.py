"""Operator 12 against plain Lloyd rounds in Python integers and against its SQL."""

import hashlib
import math
import random

import duckdb
import numpy as np

from ledgerlens.llm import op12_centroids as C
from tests.llm.conftest import SF0001


def plain(rows, k=C.CLUSTERS, rounds=C.ROUNDS, size=C.COMPONENTS):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == size
            and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept
                   if i is not None)
    centres = [v for _, v in named[:k]]

    def assign():
        out = []
        for _, v in kept:
            far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centres]
            out.append((min(far), far.index(min(far))))
        return out

    for _ in range(rounds if centres else 0):
        where = assign()
        for c in range(len(centres)):
            own = [v for (_, v), (_, w) in zip(kept, where) if w == c]
            if own:
                centres[c] = [sum(column) // len(own) for column in zip(*own)]
    if not centres:
        return []
    where = assign()
    whole = sum(d for d, _ in where)
    return sorted(((i, c, d, sum(e for e, w in where if w == c), whole,
                    hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest())
                   for (i, _), (d, c) in zip(kept, where)), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia",
        "centroid_sha256").collect()), key=str)


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")


def test_whole_table_and_sql(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in
            spark.read.parquet(f"{SF0001}/embeddings.parquet").collect()]
    out = got(C.op12_centroids(spark, SF0001))
    assert out == plain(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF0001}/embeddings.parquet'")
    cols = "vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256"
    assert out == sorted(con.execute(f"SELECT {cols} FROM ({C.OP12_SQL})").fetchall(), key=str)


def test_ties_repeats_and_rows_left_out(spark):
    rng = random.Random(3)
    grid = [(i, [float(rng.randint(-1, 1)) / 64 for _ in range(4)]) for i in range(300)]
    rows = grid + grid[:50] + [(7, [0.0] * 4)] * 200 + [
        (None, [0.5, 0.5, 0.5, 0.5]), (400, None), (401, []), (402, [1.0] * 3), (403, [1.0] * 5),
        (404, [1.0, None, 0.0, 0.0]), (405, [1.0, math.nan, 0.0, 0.0]),
        (406, [1.0, math.inf, 0.0, 0.0])]
    df = vectors(spark, rows).repartition(5)
    for k, rounds in ((5, 4), (1, 2), (16, 0)):
        assert got(C.cluster(df, k, rounds, components=4)) == plain(rows, k, rounds, 4)


def test_fewer_vectors_than_clusters_and_empty(spark):
    rows = [(i, [i / 64.0, -i / 64.0]) for i in range(3)]
    assert got(C.cluster(vectors(spark, rows), components=2)) == plain(rows, size=2)
    assert C.cluster(vectors(spark, []), components=2).collect() == []
    assert C.cluster(vectors(spark, [(None, [1.0, 2.0])]), components=2).collect() == []


def test_very_large_components_stay_within_a_long(spark):
    rows = [(1, [1e300, -1e300]), (2, [0.0, 0.0]), (3, [-1e300, 1e300])]
    out = C.cluster(vectors(spark, rows, "double"), 1, 1, components=2).collect()
    assert len(out) == 3 and all(0 <= r["distance"] < 1 << 62 for r in out)


def test_other_columns_clash(spark):
    rows = [(i, [i / 64.0, 1.0]) for i in range(40)]
    df = vectors(spark, rows).selectExpr("*", "1 AS cluster", "2 AS x", "'a' AS key", "0 AS was",
                                         "5 AS distance", "6 AS label")
    assert got(C.cluster(df, 3, 2, components=2)) == plain(rows, 3, 2, 2)


def test_rounds_scan_only_vectors_whose_gap_expired(spark):
    """Tight, distant groups: after the first scan few or no gaps expire, and each
    vector is live in one generation."""
    rng = np.random.default_rng(5)
    rows = [(i, (np.eye(8)[i % 8] * 50 + rng.normal(0, .2, 8)).tolist()) for i in range(800)]
    points = C.written(C.quantised(vectors(spark, rows), 8), "points")
    centres = np.array([[int(64 * 50) if j == g else 0 for j in range(8)] for g in range(8)])
    lloyd = C.Lloyd(points, centres)
    for _ in range(3):
        lloyd.round()
    assert lloyd.heaps[0].count() == 800
    assert sum(h.count() for h in lloyd.heaps[1:]) < 80
    assert sorted(r["vec_id"] for r in lloyd.assigned().collect()) == list(range(800))


def test_popping_reaches_the_parquet_scan(spark):
    rows = [(i, [i / 64.0, 1.0]) for i in range(40)]
    lloyd = C.Lloyd(C.written(C.quantised(vectors(spark, rows), 2), "points"),
                    np.array([[0, 64], [30, 64]]))
    lloyd.round()
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        plan = lloyd.heaps[0].where(C._between(np.array([0.0, 1.0]), np.array([2.0, 5.0])))
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = text[text.index("PushedFilters"):]
    assert "EqualTo(cluster,1)" in pushed and "LessThanOrEqual(key,5.0)" in pushed
