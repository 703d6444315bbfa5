"""A key that holds a third of all rows: the joins split it, with equal results."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import components as C
from ledgerlens.llm import frames
from ledgerlens.llm import op3_exact as X
from ledgerlens.llm import op6_lines as O
from ledgerlens.llm import op10_decontam as D
from ledgerlens.session import scratch_dir
from tests.llm.conftest import documents

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}
N = 6000


@pytest.fixture
def skewed(spark):
    saved = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in saved.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def hot_docs(spark, text, other):
    return documents(spark, [(i, text if i % 3 == 0 else other(i)) for i in range(N)]).repartition(8)


def test_a_text_of_a_third_of_all_rows(skewed):
    docs = hot_docs(skewed, "the same", lambda i: f"text {i}")
    rows, plan = final(X.decide(docs, X.DigestIndex(skewed, scratch_dir(skewed, "ix"), buckets=3)))
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert sum(r["kept"] for r in rows) == N - N // 3 + 1
    assert {r["keep_id"] for r in rows if r["doc_id"] % 3 == 0} == {0}


def test_text_ids(spark):
    docs = documents(spark, [(i, f"t{i % 4}") for i in range(12)]).withColumn(
        "doc_id", F.concat(F.lit("d"), F.format_string("%02d", "doc_id")))
    path = scratch_dir(spark, "text-ids")
    docs.write.parquet(f"{path}/documents.parquet")
    out = X.op3_exact(spark, path).collect()
    assert {r["doc_id"] for r in out if r["kept"]} == {"d00", "d01", "d02", "d03"}


def test_a_passage_of_a_third_of_all_documents(skewed):
    item = " ".join(f"w{i}" for i in range(12))
    docs = hot_docs(skewed, f"x {item} y", lambda i: f"a{i} w1 w2 w3 b{i}")
    bench = skewed.createDataFrame([(1, item), (2, "w1 w2 w3")], "item_id long, text string")
    _, hits, _ = D.occurrences(docs, bench)
    rows, plan = final(hits)
    assert "skew=true" in plan and len({r["doc_id"] for r in rows}) == N


def test_a_hub_of_a_third_of_all_links(skewed):
    links = skewed.range(3 * N).selectExpr(
        "id + 1 AS a", "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS b")
    edges = frames.written(links.selectExpr("greatest(a, b) AS v", "least(a, b) AS u"), "edges")
    _, plan = final(C._least(edges))
    assert "skew=true" in plan
    out = C.components(links).collect()
    assert len(out) == 3 * N + 1 and {r["root"] for r in out} == {0}


def test_lines_of_a_third_of_all_documents(skewed, monkeypatch):
    plans = []

    def spy(df, name):
        plans.append((name, final(df)[1]))
        return frames.written(df, name)

    monkeypatch.setattr(O, "written", spy)
    docs = hot_docs(skewed, "one\ntwo\nthree", lambda i: f"{i} a\n{i} b\n{i} c")
    out = {r["doc_id"]: r["n_removed"] for r in O.strip(docs).collect()}
    assert out == {i: 3 * (i % 3 == 0 and i > 0) for i in range(N)}
    assert "skew=true" in dict(plans)["line-meetings"]
    assert "skew=true" in dict(plans)["repeated-lines"]
