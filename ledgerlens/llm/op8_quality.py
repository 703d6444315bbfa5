"""Quality classifier (operator 8): histogram gradient-boosted trees.

Documents become ``STATS``, statistics of their whole text, in one pass. Trees are
boosted on the logistic loss over features binned at quantiles (``BINS`` bins): per
level, gradients and Hessians are summed into node x feature x bin histograms and each
node takes its best split. A tree is complete, flattened into arrays (feature and
threshold of node i, children 2i + 1 and 2i + 2, leaf values), so a batch of rows
walks all levels by numpy indexing.

The statistics of all documents are computed on Spark; the trees are fitted on at most
``LEARN_ROWS`` labelled rows (taken by hash; about 10 MB of statistics), which is all
the driver sees. Scoring runs over the statistics in tasks.

Defined results: an empty or null text has zeros for statistics and is scored like any
other. Without learning rows of both classes the score is the share of label 1 (0.5
without any). A null label or a label's null id is no label; of several labels of an
id the largest counts. Rows that repeat are rows of their own. Other columns aren't
read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.folds import held_out
from ledgerlens.llm.frames import documents, map_arrow, table, written
from ledgerlens.llm.op7_toxicity import labels_of
from ledgerlens.llm.words import SPACES, batches, split_words

LEARN_ROWS = 50_000
BINS, DEPTH, TREES, RATE, RIDGE, LEAST_WEIGHT = 64, 4, 80, 0.15, 1.0, 2.0
STATS = ("log_bytes", "log_words", "word_length", "word_length_spread", "longest_word",
         "distinct_words", "repeats_next", "repeats_second", "distinct_pairs", "upper", "digit",
         "exclaim", "symbol", "bar", "stop_comma", "other_bytes", "line_breaks", "symbol_ends",
         "upper_words", "digit_words", "same_line_starts")


def _classes() -> dict[str, np.ndarray]:
    kinds = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "exclaim": b"!?",
             "symbol": b"#$%&*+/<=>@[]^_`{}~\\", "bar": b"|", "stop_comma": b".,;:"}
    out = {}
    for name, chars in kinds.items():
        out[name] = np.zeros(256, bool)
        out[name][list(chars)] = True
    out["other_bytes"] = np.arange(256) >= 128
    out["line_breaks"] = np.arange(256) == 10
    return out


_CLASSES = _classes()


def statistics(texts: list[bytes | None]) -> np.ndarray:
    """``STATS`` of each text, as rows."""
    words = split_words(texts, SPACES)
    raw = np.frombuffer(words.buf, np.uint8)
    sizes = np.array([len(t or b"") for t in texts], np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes + 1)])
    n_bytes, n_words = np.maximum(sizes, 1), np.maximum(np.diff(words.first), 1)
    lengths = words.ends - words.starts
    doc = np.repeat(np.arange(len(texts)), np.diff(words.first))

    def per_text(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[np.minimum(bounds[1:] - 1, len(raw))] - sums[np.minimum(bounds[:-1], len(raw))]

    def per_words(values: np.ndarray) -> np.ndarray:
        return np.bincount(doc, values, len(texts)) / n_words

    def distinct(hashes: np.ndarray, of: np.ndarray) -> np.ndarray:
        order = np.lexsort((hashes, of))
        h, d = hashes[order], of[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        return np.bincount(d[new], minlength=len(texts))

    out = {"log_bytes": np.log1p(sizes), "log_words": np.log1p(np.diff(words.first))}
    mean = per_words(lengths.astype(float))
    out["word_length"] = mean
    out["word_length_spread"] = np.sqrt(np.maximum(
        per_words(lengths.astype(float) ** 2) - mean ** 2, 0))
    longest = np.zeros(len(texts))
    np.maximum.at(longest, doc, lengths)
    out["longest_word"] = longest
    h = words.hashes
    out["distinct_words"] = distinct(h, doc) / n_words
    for name, step in (("repeats_next", 1), ("repeats_second", 2)):
        same = np.zeros(len(h))
        same[step:] = (h[step:] == h[:-step]) & (doc[step:] == doc[:-step])
        out[name] = per_words(same)
    pairs, ok = words.windows(2)
    out["distinct_pairs"] = distinct(pairs[ok], doc[ok]) / n_words
    for name, kind in _CLASSES.items():
        out[name] = per_text(kind[raw]) / n_bytes
    first, last = raw[words.starts], raw[words.ends - 1]
    out["symbol_ends"] = per_words((_CLASSES["symbol"] | _CLASSES["exclaim"])[last].astype(float))
    out["upper_words"] = per_words((_CLASSES["upper"][first] & _CLASSES["upper"][
        raw[np.maximum(words.ends - 1 - _CLASSES["exclaim"][last], words.starts)]]).astype(float))
    out["digit_words"] = per_words(_CLASSES["digit"][first].astype(float))
    starts_line = np.zeros(len(h), bool)
    if len(h):
        breaks = np.concatenate([[0], np.cumsum(raw == 10)])
        line = breaks[words.starts]
        starts_line[0] = True
        starts_line[1:] = (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])
    lines = np.maximum(np.bincount(doc[starts_line], minlength=len(texts)), 1)
    out["same_line_starts"] = 1 - distinct(h[starts_line], doc[starts_line]) / lines
    return np.stack([out[s] for s in STATS], axis=1)


def document_stats(docs: DataFrame) -> DataFrame:
    """doc_id, stats (array of float) of every row."""
    def run(batch: pa.RecordBatch):
        texts = [t.as_py() for t in batch.column("text")]
        rows = [np.empty((0, len(STATS)))]
        for part in batches(texts, lambda t: len(t or b"")):
            rows.append(statistics(part))
        flat = np.concatenate(rows).astype(np.float32)
        stats = pa.ListArray.from_arrays(
            np.arange(len(flat) + 1, dtype=np.int32) * len(STATS), pa.array(flat.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), stats], names=["doc_id", "stats"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", F.col("text").cast("binary").alias("text")), run,
                     f"doc_id {kind}, stats array<float>")


@dataclass
class Trees:
    """Flattened trees: feature and threshold of each inner node (trees x nodes), value
    of each leaf (trees x leaves)."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        inner = self.feature.shape[1] if len(self.feature) else 0
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            out += value[at - inner]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _split(g: np.ndarray, h: np.ndarray):
    """Best feature and bin of one node's histograms (features x bins); bin BINS - 1
    (all rows left) when nothing gains."""
    gl, hl = np.cumsum(g, axis=1), np.cumsum(h, axis=1)
    gt, ht = gl[:, -1:], hl[:, -1:]
    gr, hr = gt - gl, ht - hl
    gain = gl ** 2 / (hl + RIDGE) + gr ** 2 / (hr + RIDGE) - gt ** 2 / (ht + RIDGE)
    gain[(hl < LEAST_WEIGHT) | (hr < LEAST_WEIGHT)] = 0
    f, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
    return (int(f), int(b)) if gain[f, b] > 1e-6 else (0, g.shape[1] - 1)


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees over the rows x with labels y (0 or 1)."""
    nothing = np.empty((0, 0))
    if not len(y) or y.min() == y.max():
        share = min(max(float(y.mean()) if len(y) else 0.5, 1e-6), 1 - 1e-6)
        return Trees(np.log(share / (1 - share)), nothing, nothing, nothing)
    n, k = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS)[1:-1])) for j in range(k)]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1)
    upper = np.full((k, BINS), np.inf)
    for j, e in enumerate(edges):
        upper[j, :len(e)] = e
    inner, leaves = 2 ** DEPTH - 1, 2 ** DEPTH
    base = float(np.log(y.mean() / (1 - y.mean())))
    margin, trees = np.full(n, base), []
    cell = np.arange(k) * BINS + binned
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        feature, bins = np.zeros(inner, np.int64), np.full(inner, BINS - 1)
        node = np.zeros(n, np.int64)
        for level in range(DEPTH):
            first, width = 2 ** level - 1, 2 ** level
            flat = (((node - first) * k * BINS)[:, None] + cell).ravel()
            g, h = (np.bincount(flat, np.repeat(v, k), width * k * BINS).reshape(width, k, BINS)
                    for v in (grad, hess))
            for i in range(width):
                feature[first + i], bins[first + i] = _split(g[i], h[i])
            node = 2 * node + 1 + (binned[np.arange(n), feature[node]] > bins[node])
        leaf = node - inner
        value = -RATE * np.bincount(leaf, grad, leaves) / (np.bincount(leaf, hess, leaves) + RIDGE)
        margin += value[leaf]
        trees.append((feature, upper[feature, bins], value))
    return Trees(base, *(np.stack(part) for part in zip(*trees)))


def train(rows: DataFrame, labels: DataFrame) -> Trees:
    """Trees from the statistics of labelled learning rows (at most ``LEARN_ROWS``)."""
    learn = rows.where(~held_out()).join(labels, "doc_id")
    n = learn.count()
    share = int(min(1.0, LEARN_ROWS / max(n, 1)) * (1 << 20))
    sample = (learn.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share)
              .select("doc_id", "stats", "label").sort("doc_id", "stats").toArrow())
    flat = sample["stats"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    x = flat.astype(np.float64).reshape(-1, len(STATS))
    return fit(x, (sample["label"].to_numpy() == 1).astype(float))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    rows = written(document_stats(docs), "quality-statistics")
    trees = docs.sparkSession.sparkContext.broadcast(train(rows, labels_of(labels, "quality")))

    def run(batch: pa.RecordBatch):
        flat = batch.column("stats").flatten().to_numpy(zero_copy_only=False)
        score = trees.value.score(flat.astype(np.float64).reshape(-1, len(STATS)))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)],
                                         names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(rows, run, f"doc_id {kind}, score double").select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document."""
    return scored(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
