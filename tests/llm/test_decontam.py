"""Operator 10 against a search of every window in every document."""

import hashlib
import re

import duckdb
from pyspark.sql import functions as F

from ledgerlens.llm import op10_decontam as D
from tests.llm.conftest import SF0001, documents, texts


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def slow(docs, items):
    windows = {}
    for item, text in items:
        ws = words(text)
        n = min(10, len(ws))
        for i in range(len(ws) - n + 1 if n else 0):
            windows.setdefault(tuple(ws[i:i + n]), set()).add(item)
    sizes = sorted({len(w) for w in windows})
    out = []
    for doc_id, text in docs:
        ws, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(ws) - n + 1):
                if (w := tuple(ws[i:i + n])) in windows:
                    hit |= set(range(i, i + n))
                    found |= {str(x) for x in windows[w] if x is not None}
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(ws), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_hit", "n_items",
                                               "items_sha256", "contaminated").collect()), key=str)


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_whole_tables(spark):
    items = [tuple(r) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    want = slow(texts(spark).items(), items)
    assert any(r[5] for r in want) and not all(r[5] for r in want)
    assert rows(D.op10_decontam(spark, SF0001)) == want


W = [f"w{i}" for i in range(40)]
ITEMS = [(1, " ".join(W[:25])), (2, " ".join(W[10:20])), (10, "Solo!"), (11, "two Words"),
         (12, ""), (13, None), (None, "no id here"), (14, "a b a b a b a b a b a b a b"),
         (2, " ".join(W[10:20])), (15, "é ü ß")]
DOCS = [(1, " ".join(W[3:18])), (2, "x " + " ".join(W[10:20]) + ", solo"), (3, " ".join(W[11:20])),
        (4, "TWO-words two, words"), (5, None), (6, ""), (7, "no id here"),
        (8, "a b " * 50), (9, "É ü ß é ü ß"), (10, " ".join(W * 3)), (None, "solo"),
        (10, "solo"), (10, "solo"), (11, "y " * 100_000 + "solo")]


def test_edges(spark):
    docs = documents(spark, DOCS).withColumn("key", F.lit(0)).withColumn("words", F.lit("x"))
    got = rows(D.contamination(docs, bench(spark, ITEMS)))
    assert got == slow(DOCS, ITEMS)
    kept = D.clean(docs, bench(spark, ITEMS))
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 5, 6]


def test_many_windows_share_a_rarest_shingle(spark):
    common = " ".join(["c1 c2 c3 c4 c5 c6 c7 c8 c9 d1 d2"] * 3)
    items = [(i, f"rare one here {' '.join(f'k{i}x{j}' for j in range(7))}") for i in range(200)]
    docs = [(0, common)] + [(i + 1, t + " tail") for i, (_, t) in enumerate(items[:150])]
    assert rows(D.contamination(documents(spark, docs), bench(spark, items))) == slow(docs, items)


def test_empty_tables(spark):
    none = bench(spark, [(1, None)])
    got = rows(D.contamination(documents(spark, DOCS), none))
    assert got == slow(DOCS, [])
    assert D.contamination(documents(spark, DOCS).where("false"), bench(spark, ITEMS)).count() == 0
    assert D.clean(documents(spark, DOCS), none.where("false")).count() == len(DOCS)


def test_sql(spark):
    con = duckdb.connect()
    for name in "documents benchmark".split():
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF0001}/{name}.parquet'")
    rel = con.sql(D.OP10_SQL)
    got = D.op10_decontam(spark, SF0001).select(rel.columns).collect()
    assert sorted(map(tuple, got)) == sorted(rel.fetchall())
