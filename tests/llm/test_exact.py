"""Operator 3 against plain Python, its SQL, and a second ingest."""

import hashlib
import re

import duckdb
from pyspark.sql import functions as F

from ledgerlens.llm import op3_exact as X
from ledgerlens.session import scratch_dir
from tests.llm.conftest import SF0001, documents

ROWS = [(5, "a  b"), (3, "a\tb"), (9, "a b "), (1, None), (2, ""), (7, " "), (8, "\n\r"),
        (4, "a b"), (4, "a b"), (None, "only"), (None, "a b"), (11, "x" * 300_000)]


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def decided(spark, docs):
    return X.decide(docs, X.DigestIndex(spark, scratch_dir(spark, "ix"), buckets=3))


def test_small(spark):
    rows = decided(spark, documents(spark, ROWS)).collect()
    assert len(rows) == len(ROWS)
    for text in {norm(t) for _, t in ROWS}:
        digest = hashlib.sha256(text.encode()).digest()
        got = [r for r in rows if bytes(r["digest"]) == digest]
        ids = [i for i, t in ROWS if norm(t) == text]
        least = min((i for i in ids if i is not None), default=None)
        assert sorted(map(str, ids)) == sorted(str(r["doc_id"]) for r in got)
        assert {r["keep_id"] for r in got} == {least}
        assert {r["group_size"] for r in got} == {len(ids)}
        assert [r["doc_id"] for r in got if r["kept"]] == [least]


def test_dedup_keeps_columns_and_one_row_each(spark):
    docs = documents(spark, ROWS).withColumn("digest", F.lit(1)).withColumn(
        "_digest", F.lit(2)).withColumn("_digest_kept", F.lit(3))
    out = X.dedup(docs)
    assert out.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in out.collect()) == ["1", "11", "3", "7", "9", "None"]


def test_second_batch_meets_the_index(spark):
    path = scratch_dir(spark, "ix")
    first = X.DigestIndex(spark, path, buckets=3)
    X.decide(documents(spark, [(5, "a"), (6, "b")]), first).collect()
    first.forget()
    again = X.DigestIndex(spark, path, buckets=3)  # another session's view of the files
    rows = X.decide(documents(spark, [(1, "a"), (2, "c"), (5, "a")]), again).collect()
    assert {(r["doc_id"], r["keep_id"], r["kept"]) for r in rows} == {
        (1, 5, False), (2, 2, True), (5, 5, True)}
    assert again.rows().count() == 3
    X.decide(documents(spark, [(1, "a"), (2, "c")]), again).collect()
    assert again.rows().count() == 3


def test_anti_join_reads_the_index_without_a_shuffle(spark):
    index = X.DigestIndex(spark, scratch_dir(spark, "ix"), buckets=3)
    index.ingest(X.groups_of(documents(spark, ROWS).select(
        "doc_id", X.digest(F.col("text")).alias("digest"))))
    plan = index.rows().select("digest").hint("merge").join(
        index.rows().hint("merge"), "digest", "left_anti")._jdf.queryExecution().toString()
    assert "Exchange" not in plan.split("Physical Plan")[1]


def test_empty(spark):
    docs = documents(spark, [(1, "a")]).where("doc_id < 0")
    assert decided(spark, docs).count() == 0
    assert X.dedup(docs).count() == 0


def test_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF0001}/documents.parquet'")
    rel = con.sql(X.OP3_SQL)
    got = X.op3_exact(spark, SF0001).select(rel.columns).collect()
    assert sorted(map(tuple, got)) == sorted(rel.fetchall())
