"""SimHash near-dedup (operator 1): meet-in-the-middle ball hashing.

Two 64-bit fingerprints differ in at most 2r bits exactly when some value lies
within r bits of both. So every distinct fingerprint emits all values within r
bits (for r = 2: 2,081 variants), variants are shuffled, and fingerprints that
meet on a variant are deduplicated, verified by their bit distance and linked.

The variants travel packed: all variants of a fingerprint with the same leading
``depth`` bits are one row (that prefix, the fingerprint), and the task that owns
the prefix unpacks them. A fingerprint so costs 1 + depth + depth(depth-1)/2 rows
(37 at depth 8, 301 at depth 24), not 2,081; the depth grows with the number of
distinct fingerprints, so a prefix stays at about ``VARIANTS`` variants at any
size. A prefix with more than ``CROWD`` variants (a dense group of near copies) isn't
worked on in one task: its rows pass on and are dealt again by a longer prefix, if
need be up to whole variants, each of which at most 2,081 distinct fingerprints share.

Links stay few: a task reduces its verified links to one star per component it
sees (smallest fingerprint, other fingerprint). Components of all tasks' stars come
from star contractions on Spark (``components.py``).

Defined results: a text without words, empty or null, has fingerprint zero. A
null doc_id takes part and is never the component's id unless all its members'
are null. Rows that repeat are rows of their own. An empty table gives no rows.
``dedup`` keeps, of each component, the document with the smallest doc_id; of
several with that id, or of null ids, the one with the smallest row key (rows that
repeat both id and text have the same key and count as one document).
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.components import components
from ledgerlens.llm.frames import (
    documents, fresh, longs, map_arrow, record, row_key, tasks, written)

U64 = np.uint64
SHINGLE, DISTANCE, SEED = 4, 4, 42
VARIANTS = 1 << 21  # variants per prefix aimed at
CROWD = 1 << 25     # variants of one prefix worked on in one task
DEEPER = 14         # bits by which the prefix of a crowd grows
_SLICE = 1 << 21    # variants sorted at a time
_BITS = 1 << 16     # shingles whose bits are summed at a time


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """SimHash of the XXH64 of the text's word shingles."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    starts, ends = starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist()
    hashes = xxhash.xxh64_digest
    votes = np.zeros(64, np.int64)
    for a in range(0, len(starts), _BITS):
        digests = b"".join([hashes(joined[s:e], SEED)
                            for s, e in zip(starts[a:a + _BITS], ends[a:a + _BITS])])
        bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(starts)).view(">u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, key (``row_key``) and fp (the fingerprint's bits as a long) of every row."""
    def run(batch: pa.RecordBatch):
        fps = [fingerprint(t.as_py(), shingle) for t in batch.column("text")]
        yield record(doc_id=batch.column("doc_id"), key=batch.column("key"),
                     fp=longs(np.array(fps, U64)))

    rows = docs.select("doc_id", row_key().alias("key"), F.col("text").cast("binary").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(rows, run, f"doc_id {kind}, key long, fp long")


@lru_cache
def masks(bits: int, weight: int) -> list[int]:
    """All ``bits``-bit values of at most ``weight`` ones."""
    return [sum(1 << b for b in on) for w in range(min(weight, bits) + 1)
            for on in combinations(range(bits), w)]


def _far(prefix: int, fps: np.ndarray, depth: int) -> np.ndarray:
    """Bits in which the leading ``depth`` bits of each fingerprint differ from prefix."""
    if not depth:
        return np.zeros(len(fps), np.uint8)
    return np.bitwise_count((fps >> U64(64 - depth)) ^ U64(prefix))


def variants(prefix: int, fps: np.ndarray, depth: int, radius: int) -> int:
    """How many variants ``unpacked`` gives."""
    far = _far(prefix, fps, depth)
    return sum(int((far == r).sum()) * len(masks(64 - depth, radius - r))
               for r in range(radius + 1))


def unpacked(prefix: int, fps: np.ndarray, depth: int, radius: int):
    """(variant, index into ``fps``) arrays, piece by piece, of the variants of
    ``fps`` whose leading ``depth`` bits are ``prefix``."""
    low = 64 - depth
    far = _far(prefix, fps, depth)
    base = (fps & U64((1 << low) - 1)) | U64(prefix << low)
    for spent in range(radius + 1):
        own = np.flatnonzero(far == spent)
        flips = np.array(masks(low, radius - spent), U64)
        step = max(1, _SLICE // len(flips))
        for a in range(0, len(own), step):
            part = own[a:a + step]
            yield (base[part][:, None] ^ flips).ravel(), np.repeat(part, len(flips))


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest index of the component of each of n nodes linked by a-b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while not np.array_equal(jumped := new[new], new):
            new = jumped
        if np.array_equal(new, root):
            return root
        root = new


def prefix_links(prefix: int, fps: np.ndarray, depth: int, distance: int) -> np.ndarray:
    """Stars (n x 2) of the components that the distinct ``fps`` form by meeting on
    variants below ``prefix``."""
    radius = distance // 2
    total = variants(prefix, fps, depth, radius)
    classes = -(-total // _SLICE)  # of variants, sorted one after another
    pairs = [np.empty((0, 2), np.int64)]
    for c in range(classes):
        found, owner = [], []
        for variant, own in unpacked(prefix, fps, depth, radius):
            if classes > 1:
                mine = (variant * U64(0x9E3779B97F4A7C15) >> U64(33)) % U64(classes) == U64(c)
                variant, own = variant[mine], own[mine]
            found.append(variant)
            owner.append(own)
        variant, own = np.concatenate(found), np.concatenate(owner)
        order = np.argsort(variant)
        variant, own = variant[order], own[order]
        met = np.flatnonzero(variant[1:] == variant[:-1])
        code = np.unique(np.minimum(own[met], own[met + 1]) * len(fps)
                         + np.maximum(own[met], own[met + 1]))
        pairs.append(np.stack([code // len(fps), code % len(fps)], axis=1))
    a, b = np.concatenate(pairs).T
    near = np.bitwise_count(fps[a] ^ fps[b]) <= distance
    root = forest(a[near], b[near], len(fps))
    linked = np.flatnonzero(root != np.arange(len(fps)))
    return np.stack([fps[root[linked]], fps[linked]], axis=1)


def _prefix_tasks(depth: int, distance: int, crowd: int):
    """mapInArrow body over rows (ball, fp) sorted by ball: links, or for a crowd
    its rows passed on (over true: a is the prefix)."""
    def out(over: bool, a, b):
        return record(over=np.full(len(a), over), a=longs(np.asarray(a, U64)),
                      b=longs(np.asarray(b, U64)))

    def run(it):
        ball, held, size, over = 0, [], 0, False

        def closed():
            if held and not over:
                links = prefix_links(ball, np.concatenate(held), depth, distance)
                yield out(False, links[:, 0], links[:, 1])

        for batch in it:
            balls = batch.column("ball").to_numpy().view(U64)
            fps = batch.column("fp").to_numpy().view(U64)
            cuts = np.flatnonzero(balls[1:] != balls[:-1]) + 1
            for a, b in zip([0, *cuts], [*cuts, len(balls)]):
                if a == b:
                    continue
                if int(balls[a]) != ball:
                    yield from closed()
                    ball, held, size, over = int(balls[a]), [], 0, False
                held.append(fps[a:b])
                size += variants(ball, fps[a:b], depth, distance // 2)
                if over or size > crowd:
                    crowded = np.concatenate(held)
                    yield out(True, np.full(len(crowded), ball, U64), crowded)
                    held, over = [], True
        yield from closed()

    return run


def _deeper(depth: int, to: int, distance: int):
    """mapInArrow body: the rows (ball, fp) of prefixes at ``depth`` as rows of the
    longer prefixes that their variants have."""
    more = to - depth

    def run(it):
        for batch in it:
            for rows in range(0, batch.num_rows, 4096):
                part = batch.slice(rows, 4096)
                balls = part.column("ball").to_numpy().view(U64)
                fps = part.column("fp").to_numpy().view(U64)
                far = _far(balls, fps, depth) if depth else _far(0, fps, 0)
                lead = (balls << U64(more)) | ((fps >> U64(64 - to)) & U64((1 << more) - 1))
                for spent in range(distance // 2 + 1):
                    own = far == spent
                    flips = np.array(masks(more, distance // 2 - spent), U64)
                    yield record(ball=longs((lead[own][:, None] ^ flips).ravel()),
                                 fp=longs(np.repeat(fps[own], len(flips))))

    return run


def links(fps: DataFrame, distance: int = DISTANCE, depth: int | None = None,
          crowd: int = CROWD) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that have the same
    components as all pairs within ``distance`` bits (an even number)."""
    if distance % 2:
        raise ValueError("the ball method takes an even bit distance")
    n, ball = fps.count(), len(masks(64, distance // 2))
    if depth is None:
        depth = max(0, min(32, int(np.ceil(np.log2(max(1, ball * n / VARIANTS))))))
    flips = F.array([F.lit(m).cast("long") for m in masks(depth, distance // 2)])
    lead = F.shiftrightunsigned("fp", 64 - depth) if depth else F.lit(0).cast("long")
    rows = (fps.select("fp", F.explode(flips).alias("flip"))
            .select(lead.bitwiseXOR(F.col("flip")).alias("ball"), "fp"))
    found = None
    while True:
        met = written(tasks(rows.repartition("ball").sortWithinPartitions("ball"),
                            _prefix_tasks(depth, distance, crowd if depth < 64 else 1 << 62),
                            "over boolean, a long, b long"), "simhash-links")
        here = met.where("NOT over").select("a", "b")
        found = here if found is None else found.unionByName(here)
        crowded = met.where("over").select(F.col("a").alias("ball"), F.col("b").alias("fp"))
        if depth == 64 or crowded.isEmpty():
            return found
        depth, last = min(64, depth + DEEPER), depth
        rows = tasks(crowded.repartition("ball", "fp"), _deeper(last, depth, distance),
                     "ball long, fp long")


def near_classes(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, key (``row_key``), fp, root (the component's smallest fingerprint)
    and component_id of every row."""
    marked = written(fingerprints(docs, shingle), "fingerprints")
    per = written(marked.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "fingerprint-ids")
    roots = components(links(per.select("fp"), distance))
    rooted = (per.join(roots, per["fp"] == roots["node"], "left")
              .select("fp", "doc_id", F.coalesce("root", "fp").alias("root")))
    named = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return marked.join(rooted.select("fp", "root").join(named, "root"), "fp")


def dedup(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One document of ``docs`` per component, with all its columns."""
    key, = fresh(docs, "_stay")
    classes = near_classes(docs, shingle, distance)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key"))
    stay = classes.groupBy("root").agg(first.alias("first")).select(F.col("first.key").alias(key))
    return docs.join(stay, row_key() == stay[key], "left_semi")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-copy component of every document."""
    out = near_classes(documents(spark, sf_dir))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      "component_id")
