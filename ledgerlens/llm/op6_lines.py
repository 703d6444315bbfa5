"""Line dedup (operator 6): winnowing over line hashes.

A document's lines (split at line feeds; white space collapsed and trimmed; empty lines
are skipped) become 64-bit hashes. Winnowing takes of each ``RUN`` consecutive lines the
smallest hash (the leftmost of equals) as a fingerprint, so every run of ``RUN`` lines
that two places share gives both the same fingerprint at the same offset. Then:

1. fingerprints that start at two places or more are kept (counts from partial sums);
2. positions are joined: the runs of ``RUN`` lines around kept fingerprints meet their
   first place, by document id, key and line, over all documents;
3. matches are extended both ways: neighbouring runs that match along one diagonal (same
   first document, same distance) become one repeated run;
4. the lines of repeated runs are deleted where they are not the first. What is first is
   judged on the input, not on what is left.

A line that a third of all documents hold is a hot key of two joins, which AQE may
split; the first places come from partial minima.

Defined results: empty lines always stay; null is the empty text. Rows that repeat both
id and text are one document. A null id sorts after all others. An empty table gives no
rows. ``strip`` keeps columns of any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.frames import (
    Bloom, documents, fresh, longs, map_arrow, record, row_key, ship, written)

RUN = 3
_RUNS = "array<struct<fp: bigint, at: int, run: bigint, pos: int, lines: array<int>>>"


def line_runs(docs: DataFrame, run: int = RUN) -> DataFrame:
    """doc_id, key, runs: for each ``run`` lines their fingerprint, its line, the run's
    hash, its number among the non-empty lines, and its lines' numbers in the text."""
    def body(batch: pa.RecordBatch):
        out = []
        for text in batch.column("text"):
            lines = [b" ".join(x.split()) for x in (text.as_py() or b"").split(b"\n")]
            where = [i for i, x in enumerate(lines) if x]
            signed = np.array([xxhash.xxh64_intdigest(lines[i]) for i in where],
                              np.uint64).view(np.int64).tolist()
            rows = []
            for p in range(len(where) - run + 1):
                window = signed[p:p + run]
                low = min(window)
                whole = xxhash.xxh64_intdigest(np.array(window, np.int64).tobytes())
                rows.append({"fp": low, "at": p + window.index(low),
                             "run": whole - (1 << 64) if whole >> 63 else whole,
                             "pos": p, "lines": where[p:p + run]})
            out.append(rows)
        kind = pa.list_(pa.struct([("fp", pa.int64()), ("at", pa.int32()), ("run", pa.int64()),
                                   ("pos", pa.int32()), ("lines", pa.list_(pa.int32()))]))
        yield record(doc_id=batch.column("doc_id"), key=batch.column("key"),
                     runs=pa.array(out, kind))

    rows = docs.select("doc_id", row_key().alias("key"), F.col("text").cast("binary").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(rows, body, f"doc_id {kind}, key long, runs {_RUNS}")


def repeated_runs(docs: DataFrame, run: int = RUN) -> DataFrame:
    """doc_id, key, pos and n (first non-empty line and number of lines of a repeated
    run), first_id, first_key, first_pos (the place it repeats), lines (in the text)."""
    found = written(line_runs(docs, run).distinct(), "line-runs")
    runs = found.select("doc_id", "key", F.explode("runs").alias("r")).select(
        "doc_id", "key", "r.*")
    again = (runs.select("fp", "doc_id", "key", "at").distinct().groupBy("fp").count()
             .where("count > 1").select("fp"))
    # tables written before each join: both its sides then come from a shuffle of their
    # own, in which AQE may split a hot fingerprint
    met = written(runs.join(written(again, "line-fingerprints"), "fp"), "line-meetings")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "pos")
    firsts = written(met.groupBy("fp", "run").agg(F.min(place).alias("first")), "line-firsts")
    later = met.join(firsts, ["fp", "run"]).where(place > F.col("first"))
    diagonal = ["doc_id", "key", "first.doc_id", "first.key"]
    ahead = Window.partitionBy(*diagonal, F.col("pos") - F.col("first.pos")).orderBy("pos")
    new = F.coalesce((F.col("pos") != F.lag("pos").over(ahead) + 1).cast("int"), F.lit(1))
    island = later.withColumn("island", F.sum(new).over(ahead))
    return (island.groupBy("doc_id", "key", F.col("first.doc_id").alias("first_id"),
                           F.col("first.key").alias("first_key"),
                           (F.col("pos") - F.col("first.pos")).alias("shift"), "island")
            .agg(F.min("pos").alias("pos"), F.array_sort(F.array_distinct(F.flatten(
                F.collect_list("lines")))).alias("lines"))
            .withColumn("n", F.size("lines"))
            .withColumn("first_pos", F.col("pos") - F.col("shift"))
            .select("doc_id", "key", "pos", "n", "first_id", "first_key", "first_pos", "lines"))


def strip(docs: DataFrame, run: int = RUN) -> DataFrame:
    """``docs`` without the lines of later repeated runs, with n_lines and n_removed.
    Only texts that may lose lines are shuffled: a Bloom filter of the losers' keys lets
    the others pass the join."""
    gone = written(repeated_runs(docs, run).groupBy("doc_id", "key").agg(
        F.array_distinct(F.flatten(F.collect_list("lines"))).alias("lines")), "repeated-lines")
    ship(docs.sparkSession)
    losers = docs.sparkSession.sparkContext.broadcast(Bloom.of(gone.select("key"), "key"))

    @F.arrow_udf("boolean")
    def may_lose(keys: pa.Array) -> pa.Array:
        return pa.array(losers.value.has(keys.to_numpy(zero_copy_only=False).view(np.uint64)))

    key, ident, lines, parts, own, may = fresh(
        docs, "_key", "_id", "_gone", "_lines", "_own", "_may")
    gone = gone.select(
        F.col("doc_id").alias(ident), F.col("key").alias(key), F.col("lines").alias(lines))
    keyed = docs.withColumn(own, row_key()).withColumn(may, may_lose(own))
    loses = keyed.where(may).join(gone, (F.col(own) == F.col(key))
                                  & F.col("doc_id").eqNullSafe(F.col(ident)), "left")
    out = loses.select(*docs.columns, lines).unionByName(keyed.where(~F.col(may)).select(
        *docs.columns, F.lit(None).cast("array<int>").alias(lines)))
    out = out.withColumn(parts, F.split(F.coalesce("text", F.lit("")), "\n")).withColumn(
        lines, F.coalesce(lines, F.array().cast("array<int>")))
    kept = F.filter(parts, lambda x, i: ~F.array_contains(F.col(lines), i))
    others = [c for c in docs.columns if c not in ("text", "n_lines", "n_removed")]
    return out.select(*others, F.array_join(kept, "\n").alias("text"),
                      F.size(parts).alias("n_lines"), F.size(lines).alias("n_removed"))


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without later repeats of runs of lines."""
    out = strip(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


OP6_SQL = rf"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
           FROM documents),
t AS (SELECT *, trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS norm FROM l),
f AS (SELECT doc_id, i, norm, row_number() OVER w AS pos,
             list(norm) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW
                              AND {RUN - 1} FOLLOWING) AS run
      FROM t WHERE norm <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
g AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) > 1 AS again
      FROM f WHERE len(run) = {RUN}),
gone AS (SELECT DISTINCT f.doc_id, f.i FROM f JOIN g ON g.doc_id = f.doc_id AND again
         AND f.pos BETWEEN g.pos AND g.pos + {RUN - 1})
SELECT l.doc_id, count(*)::INT AS n_lines, count(gone.i)::INT AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (gone.i IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.i = l.i GROUP BY l.doc_id
"""
