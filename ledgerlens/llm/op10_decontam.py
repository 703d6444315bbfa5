"""Benchmark decontamination (operator 10): prefix-filtered set join.

An item's windows (10 consecutive words; a shorter item is one window) are sets of
positioned shingles. Containment is exact, so the prefix that must be shared is
one shingle, and the shingles of a window are ordered by rarity: their number of
occurrences in all documents. The steps:

1. distinct windows with the list of their items; all their shingles go into a
   fixed-size Bloom filter;
2. one pass over all documents counts the occurrences of those shingles (partial
   sums per batch);
3. each window keeps its rarest shingle; a second pass over all documents finds
   the places of such shingles and ships, for each, the few words around it;
4. places meet windows on the shingle. Length and positional bounds: the window
   must fit the document from the shingle's place less its offset. Then the words
   are compared exactly, over as many words as the window has;
5. occurrences are merged into hit words by a running maximum over a document's
   occurrences.

Windows with one rarest shingle meet a place as one row (lists of at most
``WINDOWS_PER_ROW``), so a passage that a third of all documents hold makes one row
a place, and the join may be split by AQE on the documents' side.

Defined results: a null or word-free text has no words; a null or word-free item
has no window. An item with a null id marks words but isn't counted in ``n_items``.
Items with the same id count once. Rows that repeat get the same result each. An
empty table of documents gives no rows, an empty benchmark no hits. Only doc_id,
text, item_id and the item's text are read; ``clean`` passes all columns through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.frames import (
    Bloom, documents, fresh, longs, map_arrow, record, row_key, table, written)
from ledgerlens.llm.words import NON_WORDS, batches, split_words

WINDOW, SHINGLE = 10, 3
WINDOWS_PER_ROW = 64


def _texts(batch: pa.RecordBatch):
    """Row numbers of the batch in lists of bounded size, with their texts."""
    texts = [t.as_py() for t in batch.column("text")]
    for rows in batches(range(len(texts)), lambda i: len(texts[i] or b"")):
        yield rows, [texts[i] for i in rows]


def item_windows(bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows: words (joined by one space), n (words), items (md5 of the
    sorted ids that have it), ids, and shingles (array of (at, h))."""
    def run(batch: pa.RecordBatch):
        for rows, texts in _texts(batch):
            words = split_words(texts, NON_WORDS, lower=True)
            by_size = {k: words.windows(k)[0] for k in range(1, SHINGLE + 1)}
            out = []
            for i, row in enumerate(rows):
                a, b = int(words.first[i]), int(words.first[i + 1])
                n = min(window, b - a)
                k = min(SHINGLE, n)
                for s in range(a, b - n + 1) if n else ():
                    hashes = by_size[k][s:s + n - k + 1].view(np.int64).tolist()
                    out.append((row, words.text(s, s + n), n,
                                [{"at": j, "h": h} for j, h in enumerate(hashes)]))
            row, text, n, shingles = zip(*out) if out else ([], [], [], [])
            yield record(item=batch.column("item").take(pa.array(row, pa.int32())),
                         words=pa.array(text, pa.binary()), n=pa.array(n, pa.int32()),
                         shingles=pa.array(shingles, pa.list_(pa.struct(
                             [("at", pa.int32()), ("h", pa.int64())]))))

    items = bench.select(F.col("item_id").cast("string").alias("item"),
                         F.col("text").cast("binary").alias("text"))
    raw = map_arrow(items, run, "item string, words binary, n int, "
                                "shingles array<struct<at: int, h: bigint>>")
    ids = F.sort_array(F.collect_set("item"))
    return (raw.groupBy("words", "n", "shingles").agg(ids.alias("ids"))
            .withColumn("items", F.md5(F.array_join("ids", "\0"))))


def _sizes(windows: DataFrame) -> list[int]:
    """Shingle lengths in use: ``SHINGLE``, and below it the lengths of short items."""
    found = windows.select(F.least("n", F.lit(SHINGLE)).alias("k")).distinct().collect()
    return sorted(r["k"] for r in found)


def _counts(docs: DataFrame, sizes: list[int], wanted) -> DataFrame:
    """Occurrences in ``docs`` of the shingles that the filter lets through."""
    def run(batch: pa.RecordBatch):
        for _, texts in _texts(batch):
            words = split_words(texts, NON_WORDS, lower=True)
            for k in sizes:
                h, ok = words.windows(k)
                found, n = np.unique(h[ok & wanted.value.has(h)], return_counts=True)
                yield record(h=longs(found), seen=n)

    return (map_arrow(docs.select(F.col("text").cast("binary").alias("text")), run,
                      "h long, seen long").groupBy("h").agg(F.sum("seen").alias("seen")))


_PLACE = pa.struct([("h", pa.int64()), ("pos", pa.int32()), ("at", pa.int32()),
                    ("around", pa.binary())])


def _places(docs: DataFrame, sizes: list[int], wanted, window: int) -> DataFrame:
    """Per document its number of words and the places of wanted shingles: hash,
    first word, and the up to ``window`` - 1 words on both sides with the shingle
    as word ``at`` of them."""
    def run(batch: pa.RecordBatch):
        for rows, texts in _texts(batch):
            words = split_words(texts, NON_WORDS, lower=True)
            first = words.first
            places = [[] for _ in rows]
            for k in sizes:
                h, ok = words.windows(k)
                at = np.flatnonzero(ok & wanted.value.has(h))
                for p, d, x in zip(at.tolist(),
                                   (np.searchsorted(first, at, "right") - 1).tolist(),
                                   h[at].view(np.int64).tolist()):
                    low = max(int(first[d]), p - window + k)
                    high = min(int(first[d + 1]), p + window)
                    places[d].append({"h": x, "pos": p - int(first[d]), "at": p - low,
                                      "around": words.text(low, high)})
            pick = pa.array(rows, pa.int32())
            yield record(doc_id=batch.column("doc_id").take(pick),
                         key=batch.column("key").take(pick),
                         n_words=np.diff(first).astype(np.int64),
                         places=pa.array(places, pa.list_(_PLACE)))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(
        docs.select("doc_id", row_key().alias("key"), F.col("text").cast("binary").alias("text")),
        run, f"doc_id {kind}, key long, n_words long, "
             "places array<struct<h: bigint, pos: int, at: int, around: binary>>")


def occurrences(docs: DataFrame, bench: DataFrame, window: int = WINDOW):
    """(documents: doc_id, key, n_words, places), (hits: doc_id, key, a, b, items: the
    words a to b of the document are a window of those items), (items, ids)."""
    sc = docs.sparkSession.sparkContext
    windows = written(item_windows(bench, window), "bench-windows")
    sizes = _sizes(windows)
    shingles = windows.select("words", "n", "items", F.explode("shingles").alias("s")).select(
        "words", "n", "items", "s.at", "s.h")
    every = sc.broadcast(Bloom.of(windows.select(F.explode("shingles.h").alias("h")), "h"))
    seen = _counts(docs, sizes, every)
    rarity = F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "h", "at")
    rarest = (shingles.join(seen, "h", "left").groupBy("words", "n", "items")
              .agg(F.min(rarity).alias("r")).where("r.seen > 0")
              .select("words", "n", "items", "r.h", "r.at"))
    rarest = written(rarest, "bench-prefixes")
    prefix = sc.broadcast(Bloom.of(rarest.select("h").distinct(), "h"))
    found = written(_places(docs, sizes, prefix, window), "bench-places")

    several = F.count(F.lit(1)).over(Window.partitionBy("h"))
    lists = (rarest.withColumn("part", F.pmod(F.xxhash64("words"),
                                              F.ceil(several / WINDOWS_PER_ROW)))
             .groupBy("h", "part")
             .agg(F.collect_list(F.struct("at", "n", "words", "items")).alias("windows")))
    lists = written(lists, "bench-lists")  # places then come from a shuffle that AQE may split
    places = found.select("doc_id", "key", F.explode("places").alias("p")).select(
        "doc_id", "key", "p.h", "p.pos", "p.at",
        F.split(F.col("p.around").cast("string"), " ").alias("around"))
    low, high = F.col("at") - F.col("w.at"), F.col("at") - F.col("w.at") + F.col("w.n")
    matching = F.filter(
        F.col("windows"),
        lambda w: (F.col("at") >= w["at"])
        & (F.size("around") >= F.col("at") - w["at"] + w["n"])
        & (F.array_join(F.slice("around", F.greatest(F.lit(1), F.col("at") - w["at"] + 1),
                                w["n"]), " ") == w["words"].cast("string")))
    start = F.col("pos") - F.col("w.at")
    hits = (places.join(lists, "h").withColumn("windows", matching)
            .where(F.size("windows") > 0)
            .select("doc_id", "key", "pos", F.explode("windows").alias("w"))
            .select("doc_id", "key", start.alias("a"), (start + F.col("w.n")).alias("b"),
                    F.col("w.items").alias("items")).distinct())
    ids = windows.select("items", F.explode("ids").alias("id")).distinct()
    return found, hits, ids


def contamination(docs: DataFrame, bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row: doc_id, key, n_words, n_hit, n_items, items_sha256, contaminated."""
    found, hits, ids = occurrences(docs, bench, window)
    hits = written(hits, "bench-hits")
    before = Window.partitionBy("key", "doc_id").orderBy("a", "b").rowsBetween(
        Window.unboundedPreceding, -1)
    new = F.greatest(F.lit(0), F.col("b") - F.greatest(
        F.col("a"), F.coalesce(F.max("b").over(before), F.lit(0))))
    words = (hits.select("key", "doc_id", "a", "b").distinct().withColumn("new", new)
             .groupBy("key", "doc_id").agg(F.sum("new").alias("n_hit")))
    items = (hits.select("key", "doc_id", "items").distinct().join(ids, "items")
             .groupBy("key", "doc_id")
             .agg(F.sort_array(F.collect_set("id")).alias("ids"))
             .select("key", "doc_id", F.size("ids").cast("long").alias("n_items"),
                     F.array_join("ids", ",").alias("list")))
    out = found.select("doc_id", "key", "n_words")
    for part in (words, items):
        part = part.withColumnsRenamed({"key": "_key", "doc_id": "_id"})
        out = out.join(part, (out["key"] == part["_key"]) & out["doc_id"].eqNullSafe(part["_id"]),
                       "left").drop("_key", "_id")
    none = F.lit(0).cast("long")
    return out.select(
        "doc_id", "key", "n_words", F.coalesce("n_hit", none).alias("n_hit"),
        F.coalesce("n_items", none).alias("n_items"),
        F.sha2(F.coalesce("list", F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", none) > 0).alias("contaminated"))


def clean(docs: DataFrame, bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without a benchmark window, with all their columns."""
    key, ident = fresh(docs, "_hit_key", "_hit_id")
    _, hits, _ = occurrences(docs, bench, window)
    hit = written(hits.select("key", "doc_id").distinct(), "bench-hit-documents")
    hit = hit.select(F.col("key").alias(key), F.col("doc_id").alias(ident))
    return docs.join(hit, (row_key() == hit[key]) & docs["doc_id"].eqNullSafe(hit[ident]),
                     "left_anti")


def op10_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document, for the whole benchmark."""
    return contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark")).drop("key")


OP10_SQL = r"""
WITH low AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS big, 'abcdefghijklmnopqrstuvwxyz' AS small),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), big, small),
                                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents, low),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), big, small),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark, low),
win AS (SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS win
        FROM (SELECT item_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
              FROM (SELECT *, least(10, len(ws)) AS n FROM b WHERE len(ws) > 0))),
place AS (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS win
          FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
                FROM d, (SELECT DISTINCT n FROM win) WHERE len(ws) >= n)),
hit AS (SELECT doc_id, i, n, item_id FROM place JOIN win USING (n, win)),
words AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
          FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit WHERE item_id IS NOT NULL)
          GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
