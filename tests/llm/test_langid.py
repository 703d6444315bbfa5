"""Operator 9 against a plain Kneser-Ney model, both model paths, and held-out rows."""

import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import op9_langid as L
from tests.llm.conftest import SF0001, documents

TRAIN = [(0, "Das ist ein kleiner Satz über Äpfel.", "de"), (2, "the cat sat on the mat", "en"),
         (3, "noch ein Satz, ein Baum", "de"), (4, "a cat and a dog; the end", "en"),
         (5, "ein", "de"), (8, "the the the", "en"), (9, None, "en"), (10, "no label", None)]


def reduce(text):
    words = "".join(c.lower() if c.isalpha() else " " for c in text or "").split()
    return " ".join(words) + " " * bool(words)


def slow_models(rows):
    models = {}
    for lang in sorted({x for _, _, x in rows if x}):
        grams = Counter()
        for i, t, x in rows:
            if x == lang and zlib.crc32(str(i).encode()) % 3 != 1:
                s = "    " + reduce(t)
                grams.update(s[p - 4:p + 1] for p in range(4, len(s)))
        orders = {5: grams}
        for k in range(4, 0, -1):
            orders[k] = Counter(g[1:] for g in orders[k + 1])
        models[lang] = orders
    return models


def slow_entropy(text, orders, alphabet):
    tables = {}
    for k, grams in orders.items():
        ones, twos = (sum(n == c for n in grams.values()) for c in (1, 2))
        total, kinds = Counter(), Counter()
        for g, n in grams.items():
            total[g[:-1]] += n
            kinds[g[:-1]] += 1
        tables[k] = ((ones + 0.5) / (ones + 2 * twos + 1), total, kinds)

    def p(gram, k):
        if k == 0:
            return 1 / (alphabet + 1)
        g = gram[5 - k:]
        d, total, kinds = tables[k]
        if g[:-1] not in total:
            return p(gram, k - 1)
        n = orders[k].get(g, 0)
        return (max(n - d, 0) + d * kinds[g[:-1]] * p(gram, k - 1)) / total[g[:-1]]

    s = "    " + reduce(text)
    grams = [s[i - 4:i + 1] for i in range(4, len(s))]
    return -sum(math.log(p(g, 5)) for g in grams) / len(grams)


TEXTS = ["ein Apfel", "the dog", "  x ", "ÄÖ zz the ein", "日本", "a" * 50_000]


@pytest.fixture(scope="module")
def expected():
    models = slow_models(TRAIN)
    alphabet = len({g[-1] for m in models.values() for g in m[5]})
    return {t: [slow_entropy(t, models[x], alphabet) for x in ("de", "en")] for t in TEXTS}


@pytest.mark.parametrize("model_rows", [L.MODEL_ROWS, 0])
def test_entropies(spark, expected, model_rows):
    docs = documents(spark, TRAIN + [(100 + 3 * i, t, None) for i, t in enumerate(TEXTS)])
    got = {r["doc_id"]: r for r in L.scored(docs, model_rows).collect()}
    for i, t in enumerate(TEXTS):
        row, want = got[100 + 3 * i], expected[t]
        assert row["entropy"] == pytest.approx(min(want), rel=1e-4)
        assert row["lang_pred"] == ("de", "en")[want.index(min(want))]
        assert 0 <= row["score"] <= 1


def test_both_paths_give_the_same_digits(spark, monkeypatch):
    docs = documents(spark, TRAIN + [(100 + 3 * i, t, None) for i, t in enumerate(TEXTS)])
    arrays = {r["doc_id"]: r for r in L.scored(docs).collect()}
    joined, join = [], L.entropies_by_join
    monkeypatch.setattr(L, "entropies_by_join", lambda *a: joined.append(1) or join(*a))
    monkeypatch.setattr(L, "MODEL_CELLS", 1)
    for r in L.scored(docs).collect():
        for column in ("entropy", "score"):
            want = arrays[r["doc_id"]][column]
            assert r[column] == (want if want is None else pytest.approx(want, rel=1e-12))
    assert joined


def test_held_out_rows_are_told_right(spark):
    rows = L.op9_langid(spark, SF0001).join(
        spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = rows.where("held_out").collect()
    assert {r["doc_id"] for r in held} == {
        r["doc_id"] for r in rows.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1}
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)
    assert not any(r["rejected"] for r in held)


def test_labels_of_held_out_rows_are_not_used(spark, corpus):
    other = corpus.withColumn("lang", F.when(L.held_out(), "xx").otherwise(F.col("lang")))
    a, b = (sorted((r["doc_id"], r["lang_pred"], round(r["score"], 9))
                   for r in L.scored(d).collect()) for d in (corpus, other))
    assert a == b


def test_edges(spark):
    extra = [(1, None, "en"), (7, "", "en"), (11, " 12 !", "de"), (None, "the cat", "en"),
             (12, "the cat", "en"), (12, "the cat", "en")]
    docs = documents(spark, TRAIN + extra).withColumn("key", F.lit(1)).withColumn(
        "rejected", F.lit(True))
    got = L.identified(docs).collect()
    assert len(got) == len(TRAIN) + len(extra)
    for r in got:
        if r["doc_id"] in (1, 7, 11, 9):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
        else:
            assert r["lang_pred"] in ("de", "en") and not r["rejected"]
    kept = L.keep_known(docs)
    assert kept.columns == docs.columns and kept.count() == len(got) - 4
    assert L.identified(docs.where("false")).count() == 0
    unlabelled = L.identified(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r["lang_pred"], r["rejected"]) for r in unlabelled} == {("und", True)}


def test_gibberish_is_rejected(spark, corpus):
    junk = documents(spark, [(10**6 + 3 * i, "xqzj kvwq zzxj qqpv " * (20 + i), None) for i in range(5)])
    rows = L.identified(corpus.unionByName(junk.select(corpus.columns))).collect()
    assert {r["rejected"] for r in rows if r["doc_id"] >= 10**6} == {True}
    assert sum(r["rejected"] for r in rows if r["doc_id"] < 10**6) == 0
