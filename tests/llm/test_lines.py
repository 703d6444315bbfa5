"""Operator 6 against a table of all runs of lines."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import op6_lines as O
from tests.llm.conftest import SF0001, documents


def slow(docs, run=3):
    rows = sorted(set(docs), key=lambda d: (d[0] is None, d[0] or 0))
    seen, out = set(), {}
    for i, text in rows:
        lines = (text or "").split("\n")
        norm = [" ".join(x.encode().decode().split(None)) for x in lines]
        where = [j for j, x in enumerate(norm) if x]
        gone = set()
        for p in range(len(where) - run + 1):
            key = tuple(norm[j] for j in where[p:p + run])
            if key in seen:
                gone |= set(where[p:p + run])
            seen.add(key)
        out[i, text] = "\n".join(x for j, x in enumerate(lines) if j not in gone), len(lines), len(gone)
    return sorted((str(i), *out[i, t]) for i, t in docs)


def rows(df):
    return sorted((str(r["doc_id"]), r["text"], r["n_lines"], r["n_removed"]) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_random(spark, seed):
    rng = random.Random(seed)
    docs = [(i, "\n".join(rng.choice("abcde") + " " * rng.randint(0, 2) if rng.random() < .9 else ""
                          for _ in range(rng.randint(0, 25)))) for i in range(40)]
    assert rows(O.strip(documents(spark, docs))) == slow(docs)


def test_edges(spark):
    docs = [(1, None), (2, ""), (3, "a\nb\nc\nd"), (None, "x\na\n\n b \nc\ny"), (5, "b\nc\nd\na"),
            (6, "q\n" * 2000), (7, "\n\n"), (3, "a\nb\nc\nd"), (8, "a\n b\tb\nc\na\nb  b\n c\nz")]
    frame = documents(spark, docs)
    clash = frame.withColumn("_key", F.lit(1)).withColumn("runs", F.lit(2))
    assert rows(O.strip(clash)) == slow(docs)
    assert O.strip(frame.where("false")).count() == 0


def test_matches_are_extended(spark):
    block = "\n".join(f"line {i}" for i in range(10))
    docs = documents(spark, [(1, f"u\n{block}\nv"), (2, f"w\nx\n{block}\ny")])
    run, = O.repeated_runs(docs).collect()
    assert (run["doc_id"], run["pos"], run["n"], run["first_id"], run["first_pos"]) == (2, 2, 10, 1, 1)


def test_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF0001}/documents.parquet'")
    rel = con.sql(O.OP6_SQL)
    got = O.op6_lines(spark, SF0001).select(rel.columns).collect()
    assert sorted(map(tuple, got)) == sorted(rel.fetchall())
    assert sum(r["n_removed"] for r in got) > 0
