"""Ranked lexical search (operator 13): dense blocked BLAS multiplication.

Every document is scored for every item as a product of two matrices: term weights of
the items and impacts of the documents. The steps:

1. the items' distinct terms. Items are taken in groups of at most ``ENTRIES`` (item,
   term) pairs, sized before anything is sent to tasks; a group's terms are its
   vocabulary. The usual benchmark is one group, a larger one repeats steps 2 to 4;
2. one pass over all texts: a document's number of terms, and the places in the
   vocabulary and the counts of the terms that it shares with the items. This narrow
   table is written; N, L and the document frequencies are counted from it;
3. scoring, in blocks: a tile of at most ``TILE`` vocabulary terms times ``ITEMS``
   items, densely, by the impacts of ``DOCS`` documents on these terms. Weights and
   impacts are integers below 2**53 in float64, and a tile is never wider than what
   keeps every partial sum below 2**53, so each product is exact however BLAS orders
   its additions; tiles are added up in 64-bit integers. Tiles of items that hold none
   of a vocabulary tile's terms are skipped;
4. tie-safe top-k: of a block, everything from an item's k-th best score on goes into
   the task's list, which keeps the first k by (score, doc_id). Each task returns at
   most k documents an item, and windows over buckets of an item, then over the item,
   give the ranks.

Nothing depends on how often a term occurs: the most frequent one is a column of a
tile, and no (document, term) pair is shuffled, but for counts per term that are
summed in the tasks first. A text over ``LONG`` bytes is counted match by match, so
memory follows its distinct terms.

Defined results: a null or term-free text has no terms and is never returned; a null or
term-free item returns nothing. Rows with the same item_id (null included) are one
item, with the terms of all its rows. Document rows that repeat are documents of their
own, in any order among themselves; a null doc_id comes after all others of its score.
Empty documents or an empty benchmark give no rows. Only item_id, doc_id and the texts
are read, so other columns may have any name.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.frames import documents, map_arrow, record, table, tasks, written

TOP = 50
ENTRIES = 1 << 20
TILE, ITEMS, DOCS = 2048, 256, 1024
EXACT = 1 << 53
MOST_IMPACT = 10 ** 6  # of any term count: 10**9 tf / (1000 tf + ...)
LONG = 4 << 20
BUCKETS = 64
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")  # of UTF-8 with A-Z lower-cased


def item_terms(bench: DataFrame) -> DataFrame:
    """Distinct item_id, term (bytes), with a group number g per item."""
    def run(batch: pa.RecordBatch):
        terms = [list(counted(text.as_py())) for text in batch.column("text")]
        row = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
        yield record(item_id=batch.column("item_id").take(pa.array(row)),
                     term=pa.array([t for ts in terms for t in ts], pa.binary()))

    kind = bench.schema["item_id"].dataType.simpleString()
    pairs = written(map_arrow(
        bench.select("item_id", F.col("text").cast("binary").alias("text")), run,
        f"item_id {kind}, term binary").distinct(), "search-terms")
    sizes = written(pairs.groupBy("item_id").agg(F.count(F.lit(1)).alias("n")), "search-items")
    groups = max(1, -(-(sizes.agg(F.sum("n")).first()[0] or 0) // ENTRIES))
    while True:  # items dealt by hash: more groups until each fits or is one item
        dealt = F.pmod(F.xxhash64(F.col("item_id").cast("string")), F.lit(groups)).cast("int")
        over = (sizes.groupBy(dealt.alias("g"))
                .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("items"))
                .where((F.col("n") > ENTRIES) & (F.col("items") > 1)).limit(1).count())
        if not over:
            return pairs.withColumn("g", dealt)
        groups *= 2


def counted(text: bytes | None) -> Counter:
    """Occurrences of each term of a text."""
    text = (text or b"").lower()
    if len(text) > LONG:
        return Counter(m.group() for m in _TERM.finditer(text))
    return Counter(_TERM.findall(text))


class Vocabulary:
    """A group's items and terms: place of each term, and the (item, term) pairs ordered
    by item. Terms are placed as the items come, so an item tile has few of them."""

    def __init__(self, pairs: pa.Table):
        codes = pairs.column("item_id").combine_chunks().dictionary_encode("encode")
        items = codes.indices.to_numpy(zero_copy_only=False)
        order = np.argsort(items, kind="stable")
        self.items, self.item = codes.dictionary, items[order].astype(np.int64)
        self.place: dict[bytes, int] = {}
        terms = pairs.column("term").take(pa.array(order)).to_pylist()
        self.term = np.array([self.place.setdefault(t, len(self.place)) for t in terms], np.int64)


def shared_terms(docs: DataFrame, vocabulary) -> DataFrame:
    """Per document doc_id, n (terms with repeats), and at, tf: places in the broadcast
    ``vocabulary`` and counts of the terms it shares."""
    def run(batch: pa.RecordBatch):
        place = vocabulary.value.place
        n, at, tf = [], [], []
        for text in batch.column("text"):
            count = counted(text.as_py())
            n.append(sum(count.values()))
            both = count.keys() & place.keys()
            at.append([place[t] for t in both])
            tf.append([count[t] for t in both])
        yield record(doc_id=batch.column("doc_id"), n=pa.array(n, pa.int64()),
                     at=pa.array(at, pa.list_(pa.int32())), tf=pa.array(tf, pa.list_(pa.int64())))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", F.col("text").cast("binary").alias("text")), run,
                     f"doc_id {kind}, n long, at array<int>, tf array<bigint>")


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    """Integer weight of terms that ``df`` of ``n_docs`` documents hold."""
    top = 2 * n_docs + 2
    return np.array([math.floor(1000 * math.log(top / (2 * int(d) + 1))) for d in df], np.int64)


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Integer impact of term counts in documents of n terms, a value each."""
    if 50 * n_docs * int(n.max(initial=0)) < 1 << 62:
        m = 50 + (50 * n_docs * n) // n_terms
    else:
        m = np.array([50 + 50 * n_docs * int(x) // n_terms for x in n], np.int64)
    return (10 ** 9 * tf) // (1000 * tf + 20 * m)


class Search:
    """What a task needs to score documents for a group of items."""

    def __init__(self, vocabulary: Vocabulary, df: np.ndarray, n_docs: int, n_terms: int):
        self.items, self.item, self.term = vocabulary.items, vocabulary.item, vocabulary.term
        self.weight = weights(df, n_docs)
        self.n_docs, self.n_terms = n_docs, n_terms
        most = max(1, int(self.weight.max(initial=0))) * MOST_IMPACT
        self.width = max(1, min(TILE, (EXACT - 1) // most))

    def blocks(self):
        """(items from, to, terms from, to, dense weights) of all tiles with a pair."""
        for i in range(0, len(self.items), ITEMS):
            a, b = np.searchsorted(self.item, (i, i + ITEMS))
            tile = self.term[a:b] // self.width
            for t in np.unique(tile).tolist():
                pick = a + np.flatnonzero(tile == t)
                low = t * self.width
                high = min(low + self.width, len(self.weight))
                dense = np.zeros((min(ITEMS, len(self.items) - i), high - low))
                dense[self.item[pick] - i, self.term[pick] - low] = self.weight[self.term[pick]]
                yield i, i + len(dense), low, high, dense

    def scores(self, n: np.ndarray, first: np.ndarray, at: np.ndarray, tf: np.ndarray,
               tiles: list | None = None) -> np.ndarray:
        """Scores of a block of documents, items x documents; document d has the terms
        ``at[first[d]:first[d + 1]]``."""
        doc = np.repeat(np.arange(len(n)), np.diff(first))
        value = impacts(tf, n[doc], self.n_docs, self.n_terms)
        order = np.argsort(at, kind="stable")
        doc, value, at = doc[order], value[order], at[order]
        out = np.zeros((len(self.items), len(n)), np.int64)
        dense, held = None, None
        for i, j, low, high, weight in tiles or self.blocks():
            if held != low:
                a, b = np.searchsorted(at, (low, high))
                dense, held = np.zeros((high - low, len(n))), low
                dense[at[a:b] - low, doc[a:b]] = value[a:b]
            out[i:j] += (weight @ dense).astype(np.int64)
        return out


class Best:
    """A task's first ``top`` documents of each item by (score, doc_id)."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.least = np.ones(items, np.int64)  # a score below this can't enter
        self.item, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.doc: pa.Array | None = None

    def add(self, scores: np.ndarray, docs: pa.Array) -> None:
        """Take in the scores (items x documents) of ``docs``."""
        if scores.shape[1] > self.top:
            edge = scores.shape[1] - self.top
            self.least = np.maximum(self.least, np.partition(scores, edge, axis=1)[:, edge])
        item, doc = np.nonzero(scores >= self.least[:, None])
        if not len(item):
            return
        ids = docs.take(pa.array(doc))
        item = np.concatenate([self.item, item])
        score = np.concatenate([self.score, scores[item[len(self.item):], doc]])
        ids = pa.concat_arrays([self.doc, ids]) if self.doc is not None else ids
        rank = np.empty(len(ids), np.int64)  # nulls come last
        rank[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
        order = np.lexsort((rank, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        keep = place < self.top
        last = place == self.top - 1
        self.item, order = item[keep], order[keep]
        self.score, self.doc = score[order], ids.take(pa.array(order))
        self.least[item[last]] = np.maximum(self.least[item[last]], self.score[last[keep]])


def ranked(found: DataFrame, search, kind: str, top: int) -> DataFrame:
    """Each task's best documents: item_id, doc_id, score."""
    def run(batches):
        s = search.value
        tiles = list(s.blocks()) if len(s.items) * len(s.weight) <= 1 << 24 else None
        best = Best(len(s.items), top)
        for batch in batches:
            for a in range(0, batch.num_rows, DOCS):
                part = batch.slice(a, DOCS)
                at = part.column("at")
                first = at.offsets.to_numpy()
                best.add(s.scores(part.column("n").to_numpy(), first - first[0],
                                  at.flatten().to_numpy().astype(np.int64),
                                  part.column("tf").flatten().to_numpy(), tiles),
                         part.column("doc_id"))
        if best.doc is not None:
            yield record(item_id=s.items.take(pa.array(best.item)), doc_id=best.doc,
                         score=best.score)

    ident = found.schema["doc_id"].dataType.simpleString()
    return tasks(found.where(F.size("at") > 0), run,
                 f"item_id {kind}, doc_id {ident}, score long")


def search(docs: DataFrame, bench: DataFrame, top: int = TOP) -> DataFrame:
    """Per item its ``top`` highest-scoring documents: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    pairs = item_terms(bench)
    kind = bench.schema["item_id"].dataType.simpleString()
    best = None
    for g in sorted(r["g"] for r in pairs.select("g").distinct().collect()):
        vocabulary = Vocabulary(pairs.where(F.col("g") == g).select("item_id", "term").toArrow())
        shipped = spark.sparkContext.broadcast(vocabulary)
        found = written(shared_terms(docs, shipped), "search-shared")
        size = found.agg(F.sum("n").alias("terms"),
                         F.count_if(F.col("n") > 0).alias("docs")).first()
        if not size["terms"]:
            continue
        counts = (found.select(F.explode("at").alias("at")).groupBy("at")
                  .agg(F.count(F.lit(1)).alias("df")).toArrow())
        df = np.zeros(len(vocabulary.place), np.int64)
        df[counts["at"].to_numpy()] = counts["df"].to_numpy()
        part = ranked(found, spark.sparkContext.broadcast(
            Search(vocabulary, df, size["docs"], size["terms"])), kind, top)
        best = part if best is None else best.unionByName(part)
    if best is None:
        ident = docs.schema["doc_id"].dataType.simpleString()
        return spark.createDataFrame(
            [], f"item_id {kind}, rank int, doc_id {ident}, score long")
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    bucket = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(BUCKETS))
    first = best.withColumn("bucket", bucket).withColumn("place", F.row_number().over(
        Window.partitionBy("item_id", "bucket").orderBy(*order))).where(F.col("place") <= top)
    return (first.withColumn("rank", F.row_number().over(
        Window.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= top)
        .select("item_id", "rank", "doc_id", "score"))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 highest-scoring of all documents for each benchmark item."""
    return search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH low AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS big, 'abcdefghijklmnopqrstuvwxyz' AS small),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), big, small),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents, low),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), big, small),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark, low),
size AS (SELECT count(*) FILTER (len(ws) > 0) AS n_docs, sum(len(ws))::BIGINT AS n_terms FROM d),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ws) AS term FROM d)
       WHERE term IN (SELECT term FROM q) GROUP BY r, term),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
      FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), size),
impact AS (SELECT r, doc_id, term, (1000000000 * tf) // (1000 * tf + 20 *
             (50 + ((50 * len(ws) * n_docs) // n_terms))) AS impact
           FROM tf JOIN d USING (r), size),
score AS (SELECT item_id, r, doc_id, sum(w * impact)::BIGINT AS score
          FROM q JOIN w USING (term) JOIN impact USING (term) GROUP BY item_id, r, doc_id)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
      FROM score WHERE score > 0) WHERE rank <= 50
"""
