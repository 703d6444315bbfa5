"""Toxicity (operator 7): compression-distance classification.

Every document is cut into windows of ``WINDOW`` words. A window is compressed with
two zstandard dictionaries, one trained on ordinary text and one on toxic text; the
bytes that the toxic dictionary saves are the window's gain. Gains are small whole
numbers, and what decides is a document's largest ones, so thresholds on them are
calibrated on labelled rows. In a window a short marker's gain drowns, so words that hold
a piece of the toxic dictionary are also compressed by themselves, and those with a gain
are counted. zstandard starts no match in the last bytes of its input, so all get a
``TAIL`` that costs the same with both dictionaries.

Dictionaries. The ordinary one is zstandard's trainer's (COVER) over windows of
ordinary documents. That trainer picks what is frequent, which in a toxic document is
ordinary text too; two such dictionaries told the classes apart poorly (area under
the curve 0.73 on held-out rows). So the toxic one is trained by contrast: character
5-grams whose weight in a document is far above that in ordinary documents (z of at
least ``LEAST_Z`` and a fifth of the largest z; repeated occurrences weigh more), joined
to the longest pieces of words that consist of them, of which those stay that mark toxic
documents in the same way (the ends of ordinary words don't). How often other
languages' ordinary text has a gram plays no part beyond z. Before the
ordinary content the toxic dictionary has these pieces where the ordinary one has as
many bytes that no text holds, and the ordinary content's own places of these pieces are
blanked, so both code ordinary text alike and only the toxic one codes the pieces.

Learning is on at most ``LEARN_ROWS`` labelled rows of each class, taken by hash; that
table is bounded, so it is broadcast to find the texts. All their grams are counted on
Spark. Calibration takes all labelled learning rows: Spark counts them by capped gains
and label, and a logistic curve is fitted to that small table.

Defined results: empty and null texts have no window and get the score of zero gains.
Without learning rows of both classes the score is the share of label 1 (0.5 without
any). A null label or a label's null id is no label; of several labels of an id the
largest counts. Words of over ``LONGEST`` bytes are windows of their own, cut into
pieces of that size. Rows that repeat are rows of their own; a repeated id shares its
label. Other columns aren't read.
"""

from __future__ import annotations

from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.folds import held_out
from ledgerlens.llm.frames import documents, map_arrow, record, table, written

WINDOW, GRAM, LONGEST = 16, 5, 512
LEARN_ROWS = 20_000
LEAST_Z, LEAST_DOCS = 4.0, 3
GRAMS, PIECES_BYTES, ORDINARY_BYTES = 4096, 32_000, 32_768
SAMPLE_WINDOWS = 60_000
THRESHOLD = 0.7
TAIL = b"\1" * 24
KNOWN = 50_000  # marked words whose gain a task remembers
_CAPS = {"top": 24, "three": 48, "several": 12, "windows": 12, "marked": 7}


def windows(text: str | None) -> list[bytes]:
    """The text's windows, each with a space before and after its words."""
    words = (text or "").lower().encode().split()
    if any(len(w) > LONGEST for w in words):
        out, run = [], []
        for w in words:
            if len(w) <= LONGEST:
                run.append(w)
                continue
            out += _joined(run) + [w[i:i + LONGEST] for i in range(0, len(w), LONGEST)]
            run = []
        return out + _joined(run)
    return _joined(words)


def _joined(words: list[bytes]) -> list[bytes]:
    return [b" %b " % b" ".join(words[i:i + WINDOW]) for i in range(0, len(words), WINDOW)]


def labels_of(labels: DataFrame, column: str) -> DataFrame:
    """doc_id, label: one row a labelled id."""
    return (labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
            .groupBy("doc_id").agg(F.max(column).cast("int").alias("label")))


def learning_rows(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """text, label of at most about ``limit`` labelled rows of each class that aren't
    held out, taken by hash of the id."""
    learn = labels.where(~held_out())
    sizes = {r["label"]: r["count"] for r in learn.groupBy("label").count().collect()}
    share = F.lit(0)
    for label, n in sizes.items():
        share = F.when(F.col("label") == label, int(min(1.0, limit / n) * (1 << 20))).otherwise(share)
    sample = learn.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share)
    return docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "label")


def _grams(words: list[str]) -> Counter:
    return Counter(p[i:i + GRAM] for p in (f" {w} " for w in words)
                   for i in range(len(p) - GRAM + 1))


def _marks(learn: DataFrame, units) -> DataFrame:
    """unit, docs, n, z: how many toxic learning documents have each unit (of those that
    ``units`` counts in a list of words), its weight in them, and how far its mean weight
    in toxic documents is above that in ordinary ones. The weight in a document is the
    number of binary digits of its occurrences. Only units with ``LEAST_Z`` or more."""
    sizes = {r["label"]: r["count"] for r in learn.groupBy("label").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)

    def run(batch: pa.RecordBatch):
        found: dict[str, list[int]] = {}
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            for unit, n in units((text or "").lower().split()).items():
                w, sums = n.bit_length(), found.setdefault(unit, [0, 0, 0, 0])
                sums[0] += label == 1
                sums[1 if label == 1 else 2] += w
                sums[3] += w * w
        cols = zip(*found.values()) if found else [[]] * 4
        yield record(unit=pa.array(list(found), pa.string()), **{
            name: pa.array(list(col), pa.int64())
            for name, col in zip(("docs", "n", "ordinary", "squares"), cols)})

    counts = map_arrow(learn, run, "unit string, docs long, n long, ordinary long, squares long")
    sums = counts.groupBy("unit").agg(*[F.sum(c).alias(c) for c in counts.columns[1:]])
    if not n1 or not n0:
        return sums.select("unit", "docs", "n", F.lit(0.0).alias("z")).where("false")
    mean = (F.col("n") + F.col("ordinary")) / (n1 + n0)
    spread = F.col("squares") / (n1 + n0) - mean * mean
    z = (F.col("n") / n1 - F.col("ordinary") / n0) / F.sqrt(spread * (1 / n1 + 1 / n0) + 1e-12)
    return sums.select("unit", "docs", "n", z.alias("z")).where(F.col("z") >= LEAST_Z)


def toxic_grams(learn: DataFrame) -> set[str]:
    """The (at most ``GRAMS``) grams that mark toxic documents most."""
    marked = (_marks(learn, _grams).where(F.col("docs") >= LEAST_DOCS)
              .orderBy(F.desc("z"), "unit").limit(GRAMS).collect())
    return {r["unit"] for r in marked if r["z"] >= marked[0]["z"] / 5}


def pieces(word: str, grams: set[str]) -> list[str]:
    """The longest parts of `` word `` that consist of the grams."""
    padded, out, i = f" {word} ", [], 0
    while i <= len(padded) - GRAM:
        j = i
        while j <= len(padded) - GRAM and padded[j:j + GRAM] in grams:
            j += 1
        if j > i:
            out.append(padded[i:j + GRAM - 1])
        i = j + 1
    return out


class Dictionaries:
    """The pair of dictionaries; compressors are made in the task that uses them."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        filler = bytes(1 + i % 8 for i in range(len(toxic)))
        self.contents = (filler + ordinary, toxic + ordinary)
        self.pieces = [p for p in toxic.split(b"\0") if p]

    @classmethod
    def train(cls, learn: DataFrame) -> "Dictionaries":
        """From the learning rows (text, label). The driver gets the grams, the most
        frequent pieces up to ``PIECES_BYTES`` and at most ``SAMPLE_WINDOWS`` windows."""
        grams = toxic_grams(learn)

        def parts(words: list[str]) -> Counter:
            return Counter(p for w in words for p in pieces(w, grams))

        top = (_marks(learn, parts).orderBy(F.desc("n"), "unit")
               .limit(PIECES_BYTES // GRAM).collect() if grams else [])
        toxic = b"\0".join(r["unit"].encode() for r in reversed(top))[-PIECES_BYTES:]

        def cut(batch: pa.RecordBatch):
            yield record(w=pa.array([w for t in batch.column("text").to_pylist()
                                     for w in windows(t)], pa.binary()))

        sample = (map_arrow(learn.where("label <> 1").select("text"), cut, "w binary")
                  .orderBy(F.xxhash64("w"), "w").limit(SAMPLE_WINDOWS).collect())
        samples = [bytes(r["w"]) for r in sample]
        try:
            ordinary = zstandard.train_dictionary(ORDINARY_BYTES, samples).as_bytes()
        except zstandard.ZstdError:  # too little text for the trainer: the text itself
            ordinary = b"".join(samples)[-ORDINARY_BYTES:]
        for piece in sorted((p.strip() for p in toxic.split(b"\0")), key=len, reverse=True):
            ordinary = ordinary.replace(piece, b"\0" * len(piece)) if piece else ordinary
        return cls(toxic, ordinary)

    def marked(self):
        """A function that lists the words of a text that hold a piece, each with a space
        before and after it, as often as they occur."""
        automaton = ahocorasick.Automaton()
        for piece in self.pieces:
            automaton.add_word(piece.decode("latin-1"), len(piece))
        if not self.pieces:
            return lambda text: []
        automaton.make_automaton()

        def words(text: str | None) -> list[bytes]:
            padded = f" {b' '.join((text or '').lower().encode().split()).decode('latin-1')} "
            found = {}
            for end, length in automaton.iter(padded):
                start = end - length + 1
                a = padded.rfind(" ", 0, start + 1)
                if a not in found:
                    found[a] = padded[a:padded.index(" ", a + 1) + 1].encode("latin-1")
            return list(found.values())

        return words

    def compressors(self):
        out = []
        for content in self.contents:
            params = zstandard.ZstdCompressionParameters(
                window_log=18, chain_log=17, hash_log=17, search_log=5, min_match=4,
                target_length=64, strategy=zstandard.STRATEGY_GREEDY, write_content_size=0,
                write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
            data = zstandard.ZstdCompressionDict(
                content or b" " * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(compression_params=params)
            out.append(zstandard.ZstdCompressor(dict_data=data, compression_params=params).compress)
        return out


def gains(docs: DataFrame, pair: Dictionaries) -> DataFrame:
    """doc_id and, capped: the largest gain, the sum of the three largest, the number
    of gains of 3 or more bytes, and the binary logarithms of the number of windows and
    of the number of marked words with a gain."""
    shared = docs.sparkSession.sparkContext.broadcast(pair)
    made: dict = {}

    def run(batch: pa.RecordBatch):
        if not made:
            made.update(pair=shared.value.compressors(), marked=shared.value.marked(), known={})
        (plain, toxic), known = made["pair"], made["known"]

        def gain(w: bytes) -> int:
            return len(plain(w + TAIL)) - len(toxic(w + TAIL))

        rows = []
        for text in batch.column("text").to_pylist():
            found = sorted((gain(w) for w in windows(text)), reverse=True)
            marked = 0
            for w in made["marked"](text):
                if w not in known:
                    if len(known) >= KNOWN:
                        known.clear()
                    known[w] = gain(w) > 0
                marked += known[w]
            rows.append((max(0, found[0]) if found else 0, sum(max(0, g) for g in found[:3]),
                         sum(g >= 3 for g in found), len(found).bit_length(),
                         marked.bit_length()))
        capped = [[min(v, cap) for v in col] for col, cap in
                  zip(zip(*rows) if rows else [[]] * len(_CAPS), _CAPS.values())]
        yield record(doc_id=batch.column("doc_id"),
                     **{name: pa.array(col, pa.int32()) for name, col in zip(_CAPS, capped)})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, " + ", ".join(
        f"{name} int" for name in _CAPS))


def calibrated(rows: DataFrame, labels: DataFrame, rounds: int = 30) -> np.ndarray:
    """Weights of the logistic curve over the gains (intercept first), from all labelled
    learning rows, as counts by gains and label (fewer than 3,400,000 rows, by the caps)."""
    counts = (rows.where(~held_out()).join(labels, "doc_id")
              .groupBy(*_CAPS, "label").count().toArrow())
    x = np.stack([np.ones(len(counts))] + [counts[c].to_numpy().astype(float) for c in _CAPS], 1)
    y = (counts["label"].to_numpy() == 1).astype(float)
    n = counts["count"].to_numpy().astype(float)
    weights = np.zeros(x.shape[1])
    if not n.sum() or not 0 < (share := (n * y).sum() / n.sum()) < 1:
        share = min(max(float((n * y).sum() / n.sum()) if n.sum() else 0.5, 1e-6), 1 - 1e-6)
        weights[0] = np.log(share / (1 - share))
        return weights
    ridge = np.diag([0.0] + [0.01] * (x.shape[1] - 1))
    weights[0] = np.log(share / (1 - share))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (n * (p - y)) + ridge @ weights
        bend = (x.T * (n * p * (1 - p) + 1e-9)) @ x + ridge + 1e-9 * np.eye(len(weights))
        weights -= np.clip(np.linalg.solve(bend, slope), -2, 2)
    return weights


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, and the gains, of every row."""
    labels = labels_of(labels, "toxic")
    learn = written(learning_rows(docs, labels, LEARN_ROWS), "toxicity-learning-rows")
    rows = written(gains(docs, Dictionaries.train(learn)), "toxicity-gains")
    weights = calibrated(rows, labels).tolist()
    z = F.lit(weights[0])
    for name, w in zip(_CAPS, weights[1:]):
        z = z + F.lit(w) * F.col(name)
    score = 1 / (1 + F.exp(-z))
    return rows.select("doc_id", held_out().alias("held_out"), score.alias("score"),
                       (score >= THRESHOLD).cast("int").alias("predicted"), *_CAPS)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document."""
    return scored(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
