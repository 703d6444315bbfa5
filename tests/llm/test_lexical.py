"""Operator 13 against a plain scorer of every document for every item."""

import math
import random
import re
from collections import Counter

import numpy as np

from ledgerlens.llm import op13_lexical as S
from tests.llm.conftest import SF0001, documents, texts


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def plain(docs, items, top=50):
    """{item: [(rank, doc_id, score)]}"""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in counts]
    big, whole = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = {}
    for item, ts in wanted.items():
        scored = []
        for (doc, c), n in zip(counts, sizes):
            score = 0
            for t in ts & c.keys():
                w = math.floor(1000 * math.log((2 * big + 2) / (2 * df[t] + 1)))
                m = 100 - 50 + (50 * n * big) // whole
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc is None, doc, score))
        scored.sort(key=lambda r: r[:2] + (r[2] or 0,))
        if scored:
            out[item] = [(k + 1, r[2], r[3]) for k, r in enumerate(scored[:top])]
    return out


def got(df):
    out = {}
    for r in df.select("item_id", "rank", "doc_id", "score").collect():
        out.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    return {k: sorted(v) for k, v in out.items()}


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_whole_tables(spark):
    items = [tuple(r) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    assert got(S.op13_lexical(spark, SF0001)) == plain(list(texts(spark).items()), items)


WORDS = [f"w{i}" for i in range(12)] + ["É", "ß9", "日本"]


def random_docs(n, seed):
    rng = random.Random(seed)
    return [(i, rng.choice([" ", "-", ", "]).join(rng.choices(WORDS, k=rng.randint(0, 8))))
            for i in range(n)]


ITEMS = [(1, "W0 w1 w1 É"), (2, "w2"), (3, ""), (4, None), (5, "absent"), (None, "w3 日本"),
         (1, "ß9 w4"), (6, " ".join(WORDS))]


def test_ties_nulls_repeats(spark):
    docs = random_docs(400, 1)
    docs += [(i, t) for i, t in docs[:60]] + [(900, None), (901, ""), (902, "!!!")]
    df = documents(spark, docs).repartition(6)
    assert got(S.search(df, bench(spark, ITEMS))) == plain(docs, ITEMS)
    assert got(S.search(df, bench(spark, ITEMS), top=3)) == plain(docs, ITEMS, 3)


def test_null_ids_come_last(spark):
    docs = [(None, "w2"), (5, "w2"), (3, "w2"), (8, "other words")]
    assert got(S.search(documents(spark, docs), bench(spark, [(1, "w2")]))) == plain(docs, [(1, "w2")])


def test_empty(spark):
    some, none = documents(spark, random_docs(20, 2)), documents(spark, [])
    assert S.search(none, bench(spark, ITEMS)).collect() == []
    assert S.search(some, bench(spark, [])).collect() == []
    assert S.search(documents(spark, [(1, None), (2, "..")]), bench(spark, ITEMS)).collect() == []


def test_small_tiles_and_item_groups_change_nothing(spark, monkeypatch):
    docs = random_docs(300, 4)
    want = plain(docs, ITEMS, 10)
    # a task reads these at its start, so they are set through the shipped search itself
    monkeypatch.setattr(S, "ENTRIES", 6)
    assert got(S.search(documents(spark, docs), bench(spark, ITEMS), top=10)) == want

    vocabulary = S.Vocabulary(S.item_terms(bench(spark, ITEMS)).select("item_id", "term").toArrow())
    n_docs, n_terms = 10, 40
    df = np.arange(len(vocabulary.place)) % 7
    whole = S.Search(vocabulary, df, n_docs, n_terms)
    rng = np.random.default_rng(1)
    first = np.arange(0, 41, 4)
    at = np.concatenate([rng.permutation(len(df))[:4] for _ in range(10)])
    block = (np.full(10, 4), first, at, rng.integers(1, 5, 40))
    scores = whole.scores(*block)
    monkeypatch.setattr(S, "ITEMS", 2)
    whole.width = 3
    assert len(list(whole.blocks())) > 4
    assert (whole.scores(*block) == scores).all()


def test_tiles_stay_below_2_to_53(spark):
    vocabulary = S.Vocabulary(S.item_terms(bench(spark, ITEMS)).select("item_id", "term").toArrow())
    search = S.Search(vocabulary, np.zeros(len(vocabulary.place), int), 10 ** 12, 10 ** 15)
    assert search.width * int(search.weight.max()) * S.MOST_IMPACT < 1 << 53
    big = S.impacts(np.array([3]), np.array([10 ** 9]), 10 ** 12, 10 ** 15)
    m = 50 + 50 * 10 ** 9 * 10 ** 12 // 10 ** 15
    assert big.tolist() == [(3 * 10 ** 9) // (3000 + 20 * m)]


def test_very_long_text(spark, monkeypatch):
    long = "w1 " * 400000 + "x" * 3_000_000 + " w2" * 700000
    assert S.counted(long.encode()) == Counter(w.encode() for w in terms(long))
    docs = [(1, long), (2, "w1 w5"), (3, "nothing")]
    items = [(1, "w1 w2"), (2, "x" * 3_000_000)]
    assert got(S.search(documents(spark, docs), bench(spark, items))) == plain(docs, items)


def test_clashing_columns_and_text_ids(spark):
    docs = random_docs(80, 6)
    df = documents(spark, docs).selectExpr(
        "cast(doc_id AS string) AS doc_id", "text", "1 AS rank", "2 AS score", "3 AS n", "4 AS at",
        "5 AS tf", "6 AS item_id")
    items = bench(spark, ITEMS).selectExpr("*", "'t' AS term", "0 AS g")
    want = plain([(str(i), t) for i, t in docs], ITEMS)
    assert got(S.search(df, items)) == want
