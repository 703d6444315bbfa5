"""Centroid clustering (operator 12): exact Lloyd rounds with heap-ordered bounds.

A vector's gap is the distance to its second nearest centroid less the distance to its
own. While the centroids move less than that gap, it can't change its cluster. A
cluster's drift is its own movement and the largest movement of any other centroid,
added up over the rounds, and a vector's key is its gap plus the drift its cluster had
when the gap was measured: the gap has expired once the drift reaches the key. Each
cluster's vectors ordered by key are its heap, and popping is reading the rows with
keys up to the drift:

1. kept vectors become integers and are scanned once against the starting centroids;
   each task writes its rows sorted by (cluster, key), so a heap is a sorted stretch of
   every file;
2. a round pops the rows whose key lies between the drift before and the drift now (a
   predicate that reaches the Parquet row groups, so vectors with wide gaps aren't
   read), scans only these against all centroids, and writes them with new keys as the
   next generation. Drift never falls, so a row that was popped from an older
   generation stays popped: nothing is marked or rewritten;
3. cluster sums change only by the popped vectors that moved;
4. at the end the rows that no round popped are exactly one per vector; their exact
   distances give the result.

Distances are exact 64-bit integers; only the gaps are doubles, made smaller by
``SLACK`` of the distances behind them, so rounding can only cause a needless scan.
Equal distances have no gap and are scanned in every round, by the smaller number.
The driver holds centroids, sums and drifts: clusters x components. Nothing is shuffled
but sums per cluster, so a vector that a third of all rows repeat costs as any other.

Defined results: rows with a null or another number of components, or any null, NaN or
infinite component, are left out. Integers beyond +-2**27 are set to that bound, so a
distance always fits a long. Rows that repeat are vectors of their own. A null vec_id
never starts a centroid; equal hashes start in the order of their components. Fewer
vectors than clusters: as many centroids as vectors with an id. An empty table, or one
without ids, gives no rows. Sums beyond a long are null. Only vec_id and embedding are
read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.frames import map_arrow, record, table, written
from ledgerlens.session import scratch_dir

COMPONENTS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 16, 3, 64, 1
LARGEST = 1 << 27
SLACK = 1e-9
ROW_GROUP = 4 << 20  # small row groups, so that a pop reads little beside its range
_CHUNK = 2048


def quantised(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """vec_id and x, the integer components of the vectors that are kept."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    low, high = F.lit(float(-LARGEST)), F.lit(float(LARGEST))
    return (vectors.select("vec_id", x.alias("x")).where(F.size("x") == components).where(finite)
            .select("vec_id", F.transform(
                "x", lambda v: F.floor(F.greatest(low, F.least(high, v * F.lit(float(scale)))))
            ).alias("x")))


def starts(points: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The points with the smallest sha256 of ``seed:vec_id``, a row each."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = (points.where(F.col("vec_id").isNotNull()).select(order.alias("h"), "x")
            .orderBy("h", "x").limit(clusters).collect())
    return np.array([r["x"] for r in rows], np.int64)


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, points x centroids."""
    out = np.empty((len(x), len(centroids)), np.int64)
    for c, centroid in enumerate(centroids):
        diff = x - centroid
        np.einsum("ij,ij->i", diff, diff, out=out[:, c])
    return out


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each point (ties: the smaller number) and its gap, never
    larger than the true one."""
    far = distances(x, centroids)
    best = far.argmin(axis=1)
    at = np.arange(len(x))
    upper = np.sqrt(far[at, best].astype(float))
    if len(centroids) == 1:
        return best, np.full(len(x), np.inf)
    far[at, best] = np.iinfo(np.int64).max
    lower = np.sqrt(far.min(axis=1).astype(float))
    return best, (lower - upper) - SLACK * (1 + lower + upper)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def scan(rows: DataFrame, centroids: np.ndarray, drift: np.ndarray) -> DataFrame:
    """vec_id, x, was, cluster, key of ``rows`` (vec_id, x, was) against all centroids."""
    def run(batch: pa.RecordBatch):
        for a in range(0, batch.num_rows, _CHUNK):
            part = batch.slice(a, _CHUNK)
            best, gap = nearest(_matrix(part.column("x")), centroids)
            yield record(vec_id=part.column("vec_id"), x=part.column("x"),
                         was=part.column("was"), cluster=best.astype(np.int32),
                         key=gap + drift[best])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return map_arrow(rows, run, f"vec_id {kind}, x array<bigint>, was int, cluster int, key double")


def _heaps(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written with every file ordered by (cluster, key)."""
    path = scratch_dir(rows.sparkSession, name)
    (rows.sortWithinPartitions("cluster", "key").write.option("compression", "zstd")
     .option("parquet.block.size", str(ROW_GROUP)).parquet(path))
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _between(low: np.ndarray | None, high: np.ndarray | None) -> Column:
    """Rows of any cluster c with low[c] < key <= high[c] (None: no bound)."""
    out = F.lit(False)
    for c in range(len(high if low is None else low)):
        one = F.col("cluster") == c
        if low is not None:
            one &= F.col("key") > float(low[c])
        if high is not None:
            one &= F.col("key") <= float(high[c])
        out |= one
    return out


def _moves(rows: DataFrame, components: int) -> list:
    """Per cluster the count and component sums that ``rows`` bring to it, less those
    they take from it."""
    moved = rows.where(~F.col("was").eqNullSafe(F.col("cluster"))).select("x", F.explode(F.array(
        F.struct(F.col("cluster"), F.lit(1).alias("sign")),
        F.struct(F.col("was").alias("cluster"), F.lit(-1).alias("sign")))).alias("to"))
    return (moved.where("to.cluster IS NOT NULL").groupBy("to.cluster")
            .agg(F.sum("to.sign").alias("n"), *[
                F.sum(F.col("x")[i] * F.col("to.sign")).alias(f"s{i}") for i in range(components)])
            .collect())


class Lloyd:
    """Centroids and their bookkeeping on the driver, generations of heaps on disk."""

    def __init__(self, points: DataFrame, centroids: np.ndarray):
        self.centroids = centroids
        k, self.components = centroids.shape
        self.sums = [[0] * self.components for _ in range(k)]
        self.counts = [0] * k
        self.drift = [np.zeros(k)]  # after each update of the centroids
        self.heaps: list[DataFrame] = []  # generation g was scanned at drift[g]
        self._scan(points.withColumn("was", F.lit(None).cast("int")))

    def _scan(self, rows: DataFrame) -> None:
        heaps = _heaps(scan(rows, self.centroids, self.drift[-1]), "centroid-heaps")
        for row in _moves(heaps, self.components):
            c = row["cluster"]
            self.counts[c] += row["n"]
            self.sums[c] = [s + row[f"s{i}"] for i, s in enumerate(self.sums[c])]
        self.heaps.append(heaps)

    def popped(self) -> DataFrame:
        """The vectors whose gap has expired by the last drift and not before."""
        last = len(self.drift) - 1
        parts = [heap.where(_between(None if g == last - 1 else self.drift[last - 1],
                                     self.drift[last])) for g, heap in enumerate(self.heaps)]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out.select("vec_id", "x", F.col("cluster").alias("was"))

    def round(self) -> None:
        """Move the centroids to their vectors' floored means and assign anew."""
        moved = np.array([[s // n for s in sums] if n else old.tolist() for sums, n, old
                          in zip(self.sums, self.counts, self.centroids)], np.int64)
        step = np.sqrt(np.einsum("ij,ij->i", moved - self.centroids,
                                 moved - self.centroids).astype(float)) * (1 + SLACK)
        order = np.argsort(-step, kind="stable")
        others = np.full(len(step), step[order[0]])
        others[order[0]] = step[order[1]] if len(step) > 1 else 0.0
        self.centroids = moved
        self.drift.append((self.drift[-1] + step + others) * (1 + SLACK))
        self._scan(self.popped())

    def assigned(self) -> DataFrame:
        """vec_id, x and cluster: from each generation what no later round popped."""
        last = len(self.drift) - 1
        out = self.heaps[last]
        for heap in self.heaps[:last]:
            out = out.unionByName(heap.where(_between(self.drift[last], None)))
        return out.select("vec_id", "x", "cluster")


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS,
            components: int = COMPONENTS, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """Per kept vector: vec_id, cluster, distance, cluster_inertia, inertia,
    centroid_sha256."""
    spark = vectors.sparkSession
    points = written(quantised(vectors, components, scale), "centroid-points")
    first = starts(points, clusters, seed)
    summary = "cluster int, centroid array<bigint>, centroid_sha256 string"
    kind = points.schema["vec_id"].dataType.simpleString()
    if not len(first):
        return spark.createDataFrame(
            [], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, "
                "inertia long, centroid_sha256 string")
    lloyd = Lloyd(points, first)
    for _ in range(rounds):
        lloyd.round()
    rows = [(c, x, hashlib.sha256(",".join(map(str, x)).encode()).hexdigest())
            for c, x in enumerate(lloyd.centroids.tolist())]
    # a row a cluster on the right: small enough for a broadcast whatever the data
    centres = F.broadcast(spark.createDataFrame(rows, summary))
    distance = F.aggregate(
        F.zip_with("x", "centroid", lambda a, b: (a - b) * (a - b)),
        F.lit(0).cast("long"), lambda total, d: total + d)
    found = written(lloyd.assigned().join(centres, "cluster").select(
        "vec_id", "cluster", distance.alias("distance"), "centroid_sha256"), "centroid-distances")
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    whole = sum(sums.values())
    fits = [(c, *(v if v < 1 << 63 else None for v in (s, whole))) for c, s in sums.items()]
    totals = F.broadcast(spark.createDataFrame(
        fits, "cluster int, cluster_inertia long, inertia long"))
    return found.join(totals, "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings in 16 clusters after three rounds."""
    return cluster(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    far = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    parts = [rf"""
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e:
             floor(greatest(-{LARGEST}, least({LARGEST}, {SCALE} * e::DOUBLE)))::BIGINT) AS x
           FROM embeddings WHERE len(embedding) = {COMPONENTS}
             AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
c0 AS (SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x
       FROM (SELECT sha256('{SEED}:' || vec_id) AS h, x FROM v WHERE vec_id IS NOT NULL
             ORDER BY h, x LIMIT {CLUSTERS}))"""]
    for i in range(ROUNDS + 1):
        parts.append(f"""a{i} AS (SELECT r, min({{'d': d, 'c': c}}) AS near
        FROM (SELECT r, c, {far} AS d FROM v, c{i} AS c) GROUP BY r)""")
        if i < ROUNDS:
            parts.append(f"""s{i} AS (SELECT c, i, sum(e) AS s, count(*) AS n
        FROM (SELECT near.c AS c, unnest(x) AS e, unnest(range({COMPONENTS})) AS i
              FROM v JOIN a{i} USING (r)) GROUP BY c, i),
c{i + 1} AS (SELECT c, coalesce(y, x) AS x FROM c{i} LEFT JOIN (
        SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS y
        FROM s{i} GROUP BY c) USING (c))""")
    return ",\n".join(parts) + f"""
SELECT vec_id, near.c::INT AS cluster, near.d::BIGINT AS distance,
       (sum(near.d) OVER (PARTITION BY near.c))::BIGINT AS cluster_inertia,
       (sum(near.d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM v JOIN a{ROUNDS} USING (r) JOIN c{ROUNDS} AS c ON c.c = near.c
"""


OP12_SQL = _sql()
