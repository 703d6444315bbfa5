"""Operator 5 against plain Python and SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import op5_chat as C
from tests.llm.conftest import SF0001

TURNS = [(1, 0, "system", "Be nice."), (1, 1, "Ann", "hi"), (1, 2, "Bob", "<|im_start|>x"),
         (1, 3, "Ann", None), (1, 3, None, "who?"), (1, 3, None, "who?"), (2, 0, "system", "alone"),
         (3, None, "Ann", "late"), (3, 5, "Ann", "ü😀"), (None, 0, "Z", ""), (4, -7, "a", "b")]


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def slow(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        ms = {(t, (r or "unknown").replace("<|", "< |"), (x or "").replace("<|", "< |"))
              for c, t, r, x in rows if c == conv}
        ms = sorted(ms, key=lambda m: (m[0] is None, m[0] or 0, m[1], m[2]))
        parts = {}
        for m in ms:
            part = 1 << 62 if m[0] is None else m[0] // C.PART_TURNS
            parts.setdefault(part, []).append(m)
        for who in {m[1] for m in ms} - {"system"}:
            for part, own in parts.items():
                for a in range(0, len(own), C.PART_ROWS):
                    text, mask = "", []
                    for _, role, content in own[a:a + C.PART_ROWS]:
                        head = "assistant" if role == who else (
                            role if role == "system" else f"user name={role}")
                        text += f"<|im_start|>{head}\n"
                        if role == who:
                            mask.append((len(text), len(text) + len(content) + len("<|im_end|>")))
                        text += f"{content}<|im_end|>\n"
                    out[conv, who, part, a // C.PART_ROWS] = text, mask
    return out


def got(df):
    return {(r["conv_id"], r["participant"], r["part"], r["chunk"]):
            (r["text"], [tuple(s) for s in r["mask"]]) for r in df.collect()}


def test_small(spark):
    turns = conversations(spark, TURNS).withColumn("part", F.lit(9)).withColumn("n", F.lit(9))
    assert got(C.rotated(turns)) == slow(TURNS)
    assert C.rotated(turns.where("false")).count() == 0


def test_mask_marks_the_participant_only(spark):
    for r in C.rotated(conversations(spark, TURNS)).collect():
        own = [m["content"] for m in r["messages"] if m["train"]]
        assert [r["text"][a:b] for a, b in r["mask"]] == [f"{c}<|im_end|>" for c in own]


def test_long_conversations_are_parts(spark, monkeypatch):
    monkeypatch.setattr(C, "PART_TURNS", 7)
    monkeypatch.setattr(C, "PART_ROWS", 3)
    rows = [(1, t, f"r{t % 4}", f"text {t}") for t in range(40)]
    rows += [(2, 0, "same turn", f"text {t}") for t in range(20)] + [(3, 1, "x", "y" * 200_000)]
    assert got(C.rotated(conversations(spark, rows))) == slow(rows)


@pytest.mark.parametrize("sf", [SF0001])
def test_sql(spark, sf):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    rel = con.sql(C.OP5_SQL)
    rows = C.op5_chat(spark, sf).select(rel.columns).collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, rel.fetchall()))
