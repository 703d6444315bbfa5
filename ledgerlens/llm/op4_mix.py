"""Mixing sources to target weights (operator 4): Pfair scheduling.

Documents go into pools by source; a pool's documents, in the order of the md5 of
their ids, fill blocks of ``block`` documents. Time runs in slots of one block. A pool
with w of Q shares releases its block j at slot floor(j * Q / w) and must place it
before slot ceil((j + 1) * Q / w); of the released blocks the one with the earliest
deadline takes the slot (ties: the pool that sorts first). For one resource and shares
that sum to Q this is feasible, so after any number t of slots every pool has had
t * w / Q blocks, give or take less than one.

The schedule repeats every Q slots, so Q entries (at most ``MOST_SHARES``; a bounded
table, broadcast) place every block of any corpus: slot = (j div w) * Q + entry of
(pool, j mod w). Nothing sequential runs over the data. A document's number in its
pool comes from counts per (pool, leading md5 digits) and a row number within these
buckets, so a source with a third of all rows is spread over as many tasks as it has
buckets; their number follows the largest pool.

All documents are placed once: none is dropped or repeated. ``balanced`` is true up to
the slot at which the first pool has run out; that prefix has the target weights.
Later slots stay empty where a pool has no block left; the others' order goes on.

Defined results: sources without a weight, and null, share the pool ``OTHER``, whose
weight is ``other``. Pools without documents are left out of the schedule. A null
doc_id sorts as the empty text; rows that repeat an id are ordered by a hash of their
columns, and of identical rows the order doesn't matter. An empty table gives no rows.
Columns pass through whatever their names, but for the results' own, which win.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.frames import documents, fresh, written

OTHER = "(other)"
MOST_SHARES = 10_000
BUCKET_ROWS = 50_000
#: the registered query's target: shares of 100, 4 of them for sources not named
WEIGHTS = {"src0": 10, **{f"src{i}": 4 for i in range(1, 10)}, **{f"src{i}": 5 for i in range(10, 20)}}
OTHER_WEIGHT, BLOCK = 4, 8


def window_of(j: int, w: int, q: int) -> tuple[int, int]:
    """Release and deadline of a pool's block j, for w of q shares."""
    return j * q // w, -(-(j + 1) * q // w)


def period(shares: dict[str, int]) -> list[tuple[str, int, int]]:
    """(pool, block, slot) of one period, by earliest deadline first."""
    q, placed, done = sum(shares.values()), [], dict.fromkeys(sorted(shares), 0)
    if q > MOST_SHARES or any(w < 1 for w in shares.values()):
        raise ValueError(f"weights must be 1 or more and sum to {MOST_SHARES} at most")
    for slot in range(q):
        ready = [(window_of(j, shares[p], q)[1], p) for p, j in done.items()
                 if j < shares[p] and window_of(j, shares[p], q)[0] <= slot]
        _, pool = min(ready)
        placed.append((pool, done[pool], slot))
        done[pool] += 1
    return placed


def mix(docs: DataFrame, weights: dict[str, int], other: int = 1, block: int = BLOCK) -> DataFrame:
    """``docs`` with pool, block_no, release, deadline, slot, place (order in the mix:
    sort by it) and balanced."""
    spark = docs.sparkSession
    results = ["pool", "block_no", "release", "deadline", "slot", "place", "balanced"]
    md5, bucket, before, rank, entry_no, entry_slot, share = fresh(
        docs, "_md5", "_bucket", "_before", "_rank", "_entry", "_slot", "_share")
    kept = [c for c in docs.columns if c.lower() not in results]
    own = [c for c in kept if c != "source"]
    named = F.when(F.col("source").isin(list(weights)), F.col("source")).otherwise(OTHER)
    rows = docs.select("source", *own, named.alias("pool"), F.md5(F.coalesce(
        F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias(md5))

    sizes = {r["pool"]: r["count"] for r in rows.groupBy("pool").count().collect()}
    shares = {p: weights.get(p, other) for p in sizes}
    digits = 0
    while max(sizes.values(), default=0) > BUCKET_ROWS * 16 ** digits:
        digits += 1
    digits = max(digits, 2) if sizes else 0

    rows = rows.withColumn(bucket, F.substring(md5, 1, digits))
    per = rows.groupBy("pool", bucket).count()
    ahead = Window.partitionBy("pool").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = written(per.select("pool", bucket, F.coalesce(F.sum("count").over(ahead), F.lit(0))
                                .alias(before)), "mix-buckets")
    order = Window.partitionBy("pool", bucket).orderBy(
        md5, "doc_id", F.xxhash64(*[F.col(c) for c in kept]))
    numbered = rows.withColumn(rank, F.row_number().over(order) - 1)
    number = F.col(rank) + F.col(before)

    q = sum(shares.values())
    entries = period(shares) if shares else []
    entry = {(p, j): slot for p, j, slot in entries}
    ends = [(-(-n // block) // shares[p]) * q + entry[p, -(-n // block) % shares[p]]
            for p, n in sizes.items()]
    placed = spark.createDataFrame(entries, f"pool string, {entry_no} long, {entry_slot} long")
    weighted = spark.createDataFrame(sorted(shares.items()), f"pool string, {share} long")
    out = (numbered.join(starts, ["pool", bucket]).withColumn("place", number)
           .withColumn("block_no", F.floor(F.col("place") / block))
           .join(F.broadcast(weighted), "pool")
           .withColumn(entry_no, F.col("block_no") % F.col(share))
           .join(F.broadcast(placed), ["pool", entry_no]))
    q = F.lit(q).cast("long")
    ahead = F.expr(f"block_no div {share}") * q
    slot = ahead + F.col(entry_slot)
    return out.select(
        *kept, "pool", "block_no",
        (ahead + F.floor(F.col(entry_no) * q / F.col(share))).alias("release"),
        (ahead + F.ceil((F.col(entry_no) + 1) * q / F.col(share))).alias("deadline"),
        slot.alias("slot"), (slot * block + F.col("place") % block).alias("place"),
        (slot < min(ends, default=0)).alias("balanced"))


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every document in the mix."""
    docs = documents(spark, sf_dir).select("doc_id", "source")
    return mix(docs, WEIGHTS, OTHER_WEIGHT, BLOCK)


def _sql() -> str:
    """DuckDB SQL; the period is a recursion over slots, one block each."""
    shares = ", ".join(f"('{p}', {w})" for p, w in WEIGHTS.items())
    return f"""
WITH RECURSIVE target(pool, w) AS (VALUES {shares}, ('{OTHER}', {OTHER_WEIGHT})),
d AS (SELECT doc_id, source, CASE WHEN source IN (SELECT pool FROM target) THEN source
             ELSE '{OTHER}' END AS pool FROM documents),
share AS (SELECT pool, w, sum(w) OVER () AS q, count(*) OVER () AS pools,
                 row_number() OVER (ORDER BY pool) AS k
          FROM target WHERE pool IN (SELECT pool FROM d)),
edf(slot, done, taken) AS (
    SELECT 0::BIGINT, (SELECT list(0::BIGINT ORDER BY k) FROM share), NULL::BIGINT
    UNION ALL
    SELECT slot + 1, [CASE WHEN i = pick THEN x + 1 ELSE x END for x, i in done], pick
    FROM (SELECT e.slot, e.done,
                 (SELECT s.k FROM share s WHERE e.done[s.k] < s.w AND e.done[s.k] * s.q // s.w <= e.slot
                  ORDER BY ceil((e.done[s.k] + 1) * s.q / s.w), s.pool LIMIT 1) AS pick
          FROM edf e WHERE e.slot < (SELECT max(q) FROM share)) n),
entry AS (SELECT s.pool, e.done[s.k] - 1 AS j, e.slot - 1 AS s, s.w, s.q
          FROM edf e JOIN share s ON s.k = e.taken),
r AS (SELECT *, row_number() OVER (PARTITION BY pool ORDER BY md5(doc_id::VARCHAR), doc_id) - 1 AS n,
             count(*) OVER (PARTITION BY pool) AS size FROM d),
b AS (SELECT r.*, n // {BLOCK} AS block_no, e.w, e.q, e.j, (n // {BLOCK} // e.w) * e.q + e.s AS slot,
      FROM r JOIN entry e ON e.pool = r.pool AND e.j = (n // {BLOCK}) % e.w),
run_out AS (SELECT min((blocks // e.w) * e.q + e.s) AS t
            FROM (SELECT pool, (count(*) + {BLOCK - 1}) // {BLOCK} AS blocks FROM d GROUP BY pool) c
            JOIN entry e ON e.pool = c.pool AND e.j = c.blocks % e.w)
SELECT doc_id, source, pool, block_no, (block_no * q // w)::BIGINT AS release,
       (((block_no + 1) * q + w - 1) // w)::BIGINT AS deadline, slot::BIGINT AS slot,
       (slot * {BLOCK} + n % {BLOCK})::BIGINT AS place, slot < (SELECT t FROM run_out) AS balanced
FROM b
"""


OP4_SQL = _sql()
