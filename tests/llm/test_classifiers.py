"""Operators 7 and 8: held-out accuracy, the fold, and defined results."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import op7_toxicity as T
from ledgerlens.llm import op8_quality as Q
from tests.llm.conftest import documents

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def auc(rows, column):
    one = [r["score"] for r in rows if r[column] == 1]
    zero = np.sort([r["score"] for r in rows if r[column] == 0])
    return np.mean((np.searchsorted(zero, one, "left") + np.searchsorted(zero, one, "right"))
                   / 2 / len(zero))


def held_out_rows(df, labels):
    rows = df.join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in rows)
    return rows


def test_toxicity(spark, labels):
    rows = held_out_rows(T.op7_toxicity(spark, SF), labels)
    clean = [r for r in rows if r["toxic"] == 0]
    assert auc(rows, "toxic") > 0.8
    assert sum(r["predicted"] for r in clean) <= 0.01 * len(clean)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)


def test_toxicity_in_each_language(spark, labels):
    lang = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = held_out_rows(T.op7_toxicity(spark, SF), labels.join(lang, "doc_id"))
    for name in ("de", "en", "es", "fr"):
        assert auc([r for r in rows if r["lang"] == name], "toxic") > 0.85
    others = [r for r in rows if r["lang"] != "en" and r["toxic"] == 1]
    assert sum(r["predicted"] for r in others) > 0.4 * len(others)


def test_quality(spark, labels):
    rows = held_out_rows(Q.op8_quality(spark, SF), labels)
    assert auc(rows, "quality") > 0.98
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.97 * len(rows)


def test_pieces():
    grams = {" abcd", "abcde", "xyzab"}
    assert T.pieces("abcdef", grams) == [" abcde"]
    assert T.pieces("qxyzab", grams) == ["xyzab"]
    assert T.pieces("no", grams) == []


def test_marked_words():
    words = T.Dictionaries(" abcd\0xyz\0é".encode(), b"").marked()
    assert sorted(words("ABCDE q axyz\n axyz abc zabcd né")) == [
        b" abcde ", b" axyz ", b" axyz ", " né ".encode()]
    assert words(None) == T.Dictionaries(b"", b"").marked()("abcd") == []


def test_windows_hold_the_whole_text():
    text = " ".join(f"w{i}" for i in range(50)) + " " + "L" * 2000 + " end"
    joined = b"".join(T.windows(text)).replace(b" ", b"")
    assert joined == text.lower().replace(" ", "").encode()
    assert T.windows(None) == T.windows(" \n") == []


@pytest.mark.parametrize("op,column", [(T, "toxic"), (Q, "quality")])
def test_edges(spark, op, column):
    docs = [(i, "some plain words here " * 5 if i % 2 else "you idiot fool !! !! " * 5)
            for i in range(60)]
    docs += [(None, "x"), (61, None), (62, ""), (63, "L" * 100_000), (63, "again"), (64, " \t\n")]
    frame = documents(spark, docs).withColumn("label", F.lit(1)).withColumn("stats", F.lit(2))
    kind = f"doc_id long, {column} int"
    some = spark.createDataFrame([(i, 1 - i % 2) for i in range(60)]
                                 + [(None, 1), (61, None), (3, 0)], kind)
    got = op.scored(frame, some).collect()
    assert len(got) == len(docs)
    assert all(0 <= r["score"] <= 1 and not math.isnan(r["score"]) for r in got)
    by_id = {r["doc_id"]: r["score"] for r in got}
    assert by_id[62] == by_id[64] or op is Q
    assert by_id[61] == by_id[62]
    assert min(by_id[i] for i in range(0, 60, 2)) > max(by_id[i] for i in range(1, 60, 2))
    assert {r["held_out"] for r in got if r["doc_id"] is None} == {False}
    one_class = op.scored(frame, some.where(f"{column} = 1")).collect()
    assert len({r["score"] for r in one_class}) == 1 and one_class[0]["score"] > 0.9
    none = op.scored(frame, some.where("false")).collect()
    assert {round(r["score"], 9) for r in none} == {0.5}
    assert op.scored(frame.where("false"), some).count() == 0


def test_held_out_labels_are_not_used(spark):
    docs = documents(spark, [(i, ("bad awful thing " if i % 2 else "nice day today ") * (5 + i % 7))
                             for i in range(120)])
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(120)],
                                   "doc_id long, toxic int, quality int")
    turned = labels.select("doc_id", *[F.when(T.held_out(), 1 - F.col(c)).otherwise(F.col(c))
                                       .cast("int").alias(c) for c in ("toxic", "quality")])
    for op in (T, Q):
        a, b = (sorted((r["doc_id"], r["score"]) for r in op.scored(docs, x).collect())
                for x in (labels, turned))
        assert a == b


def test_trees_walk_like_plain_code():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, len(Q.STATS)))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    trees = Q.fit(x, y)
    assert ((trees.score(x) >= 0.5) == y).mean() > 0.97
    for row, score in zip(x[:20], trees.score(x[:20])):
        margin = trees.base
        for f, t, v in zip(trees.feature, trees.threshold, trees.value):
            at = 0
            while at < len(f):
                at = 2 * at + (2 if row[f[at]] > t[at] else 1)
            margin += v[at - len(f)]
        assert score == pytest.approx(1 / (1 + math.exp(-margin)))
