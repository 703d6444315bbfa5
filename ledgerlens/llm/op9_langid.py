"""Language ID (operator 9): interpolated Kneser-Ney character models.

Texts are reduced to lower-case letters with one space for whatever lies between
and one at the end (and four before the first letter, as context only). For each language of the learning rows, Spark counts
all 5-grams of all their texts; lower orders are continuation counts (in how many
distinct longer grams a gram ends). With absolute discounts from the counts of counts,

    p_k(c | ctx) = max(n_k - D_k, 0) / total_k(ctx) + lambda_k(ctx) * p_{k-1}(c | ctx')

and p_0 is uniform. A model is, for each order, the grams' first terms and the
contexts' lambdas, as arrays sorted by 64-bit hash with a column per language. A
document's score in a language is its cross-entropy in nats per character; the lowest
wins.

Up to ``MODEL_ROWS`` rows and ``MODEL_CELLS`` rows times languages the arrays are broadcast
(checked before; at most 64 MB of values and 32 MB of hashes). Otherwise the model is
joined, with its values and the logarithms rounded to single precision as the arrays have.
A larger model stays a Spark table: documents' gram counts meet it in joins
(``entropies_by_join``), with equal results.

Rejection is calibrated on all learning rows whose prediction is their label: per
language and length class (powers of four) a document is rejected when its
cross-entropy lies more than ``SIGMAS`` standard deviations above the class's mean
(a class of under ``FEW`` rows takes the widest limit of its language, else of all
languages; without any class nothing is rejected). It is a column of
its own; ``lang_pred`` is still the best language.

Defined results: a null text or one without a letter is ``und`` with score 0 and is
rejected. Without learning rows everything is ``und``. Ties go to the language that
sorts first. Learning rows are those whose crc32 of the id modulo 3 is not 1 and whose
lang isn't null; a null id counts as the empty text there. Rows that repeat are rows
of their own. Other columns aren't read; ``keep_known`` passes them through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.folds import held_out
from ledgerlens.llm.frames import documents, fresh, map_arrow, record, row_key, tasks, written
from ledgerlens.llm.words import batches, mix

ORDER = 5
MODEL_ROWS = 4_000_000
MODEL_CELLS = 16_000_000  # 4 bytes each
SIGMAS, FEW, LEAST_SPREAD = 8.0, 20, 0.1
UNKNOWN = "und"
_CHARS = 1 << 20
_KNOWN = 1 << 20  # grams whose probabilities a task remembers
_SPACE = 32
_fold: list[np.ndarray] = []


def fold() -> np.ndarray:
    """Code point -> lower-case letter, or space."""
    if not _fold:
        table = np.full(0x110000, _SPACE, np.uint32)
        for cp in range(0x110000):
            if (c := chr(cp)).isalpha():
                low = c.lower()
                table[cp] = ord(low) if len(low) == 1 else cp
        _fold.append(table)
    return _fold[0]


def reduced(texts: list[str | None]):
    """Code points of the reduced texts, each after ORDER - 1 spaces; the places of
    their characters; the number of characters of each text (0: no letter)."""
    pad = ORDER - 1
    raw = "".join([f"{t or ''}\n" for t in texts]).encode("utf-32-le", "replace")
    cps = fold()[np.frombuffer(raw, np.uint32)]
    lengths = np.array([len(t or "") for t in texts], np.int64)
    doc = np.repeat(np.arange(len(texts)), lengths + 1)
    blank = cps == _SPACE
    keep = ~blank
    keep[1:] |= blank[1:] & ~blank[:-1] & (doc[1:] == doc[:-1])
    n = np.bincount(doc[keep], minlength=len(texts)).astype(np.int64)
    ends = np.cumsum(n + pad)
    out = np.full(int(ends[-1]) if len(ends) else 0, _SPACE, np.uint32)
    at = np.arange(int(n.sum())) + pad * (doc[keep] + 1)
    out[at] = cps[keep]
    return out, at, n


#: odd multipliers of a gram's last, last but one, ... character
_MULTIPLIERS = [np.uint64(pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64)) for k in range(ORDER)]


def gram_hashes(cps: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Hashes of the grams of 0 to ORDER characters that end at each place."""
    h = np.zeros(len(at), np.uint64)
    out = [mix(h)]
    for k in range(ORDER):
        h = h + (cps[at - k].astype(np.uint64) + np.uint64(1)) * _MULTIPLIERS[k]
        out.append(mix(h))
    return out


def distinct_grams(cps: np.ndarray, at: np.ndarray, salt: np.ndarray | None = None):
    """The distinct ORDER-grams (each with its ``salt``) that end at the places: their
    hashes, the index in ``at`` of one place of each, and each place's number among
    them."""
    chars = cps.astype(np.uint64) + np.uint64(1)
    h = np.zeros(len(chars) - ORDER + 1, np.uint64)
    for k in range(ORDER):
        h += chars[ORDER - 1 - k:len(chars) - k] * _MULTIPLIERS[k]
    h = mix(h[at - ORDER + 1])
    coded = pa.array((h if salt is None else mix(h + salt)).view(np.int64)).dictionary_encode()
    number = coded.indices.to_numpy()
    one = np.empty(len(coded.dictionary), np.int64)
    one[number[::-1]] = np.arange(len(at))[::-1]
    return h[one], one, number


def _grams(batch: pa.RecordBatch):
    """Row numbers in lists of bounded size, with what ``reduced`` gives for them."""
    texts = batch.column("text").to_pylist()
    for rows in batches(range(len(texts)), lambda i: len(texts[i] or ""), _CHARS):
        cps, at, n = reduced([texts[i] for i in rows])
        yield rows, cps, at, n


def _strings(cps: np.ndarray, at: np.ndarray) -> list[str]:
    """The ORDER-grams that end at the places."""
    chars = np.stack([cps[at - k] for k in range(ORDER - 1, -1, -1)], axis=1)
    text = np.ascontiguousarray(chars).tobytes().decode("utf-32-le")
    return [text[i:i + ORDER] for i in range(0, len(text), ORDER)]


def gram_counts(docs: DataFrame, group: str) -> DataFrame:
    """(group, gram, n): ORDER-grams counted per value of the string column ``group``.
    A task sums its batches before it hands them on, up to ``_KNOWN`` grams at a time."""
    def counted(batch: pa.RecordBatch):
        coded = batch.column(group).dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        for rows, cps, at, n in _grams(batch):
            if len(at):
                own = np.repeat(codes[np.array(rows, int)], n).astype(np.uint64)
                _, one, number = distinct_grams(cps, at, own * np.uint64(0x9E3779B97F4A7C15))
                yield pa.table({
                    group: coded.dictionary.take(pa.array(own[one].astype(np.int64))),
                    "gram": pa.array(_strings(cps, at[one]), pa.string()),
                    "n": np.bincount(number)})

    def run(it):
        held, size = [], 0

        def summed():
            table = pa.concat_tables(held).group_by([group, "gram"]).aggregate([("n", "sum")])
            return table.rename_columns({"n_sum": "n"}).select([group, "gram", "n"])

        for batch in it:
            for part in counted(batch):
                held.append(part)
                size += len(part)
                if size > _KNOWN:
                    held = [summed()]
                    size = len(held[0])
                    if size > _KNOWN // 2:
                        yield from held[0].to_batches(max_chunksize=100_000)
                        held, size = [], 0
        if held:
            yield from summed().to_batches(max_chunksize=100_000)

    counts = tasks(docs.select(group, "text"), run, f"{group} string, gram string, n long")
    return counts.groupBy(group, "gram").agg(F.sum("n").alias("n"))


def kneser_ney(counts: DataFrame, langs: list[str]) -> dict[int, DataFrame]:
    """The models: per order lang, part (0: a gram's first term, 1: a context's
    lambda), gram, value. counts: lang, gram, n. Each order's counts and model are
    written before the next is begun, so no plan spans more than one of them."""
    out, table = {}, counts
    for k in range(ORDER if langs else 0, 0, -1):
        if k < ORDER:
            table = written(table.groupBy("lang", F.substring("gram", 2, k).alias("gram")).agg(
                F.count(F.lit(1)).alias("n")), f"language-grams-{k}")
        ones, twos = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
        discounts = table.groupBy("lang").agg(
            ((ones + 0.5) / (ones + 2 * twos + 1)).alias("d")).collect()
        d = F.element_at(F.create_map(*[F.lit(x) for r in discounts for x in (r["lang"], r["d"])]),
                         F.col("lang"))
        context = table.groupBy("lang", F.substring("gram", 1, k - 1).alias("context")).agg(
            F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        grams = table.withColumn("context", F.substring("gram", 1, k - 1)).join(
            context, ["lang", "context"])
        parts = grams.select("lang", F.lit(0).alias("part"), "gram", (
            F.greatest(F.col("n") - d, F.lit(0.0)) / F.col("total")).alias("value"))
        rest = context.select("lang", F.lit(1), "context",
                              d * F.col("kinds") / F.col("total"))
        out[k] = written(parts.unionAll(rest), f"language-model-{k}")
    return out


def _hash_of(batch: pa.RecordBatch, langs: list[str]):
    """Hash of each gram, as ``gram_hashes`` has it, and the place of its language."""
    grams = batch.column("gram").to_pylist()
    out = np.empty(len(grams), np.uint64)
    lengths = np.array([len(g) for g in grams], np.int64)
    for k in np.unique(lengths):
        own = np.flatnonzero(lengths == k)
        cps = np.frombuffer("".join(grams[i] for i in own).encode("utf-32-le"), np.uint32)
        h = np.zeros(len(own), np.uint64)
        for j in range(k):
            h += (cps[k - 1 - j::k].astype(np.uint64) + np.uint64(1)) * _MULTIPLIERS[j]
        out[own] = mix(h)
    yield record(code=pc.index_in(batch.column("lang"), pa.array(langs, pa.string())),
                 h=pa.array(out.view(np.int64)), value=batch.column("value"))


class Models:
    """Sorted hash arrays: for each order and part (hashes, values: a row a hash, a
    column a language)."""

    def __init__(self, langs: list[str], alphabet: int):
        self.langs, self.floor, self.parts = langs, 1.0 / (alphabet + 1), {}

    @classmethod
    def of(cls, model: dict[int, DataFrame], langs: list[str], alphabet: int) -> "Models":
        """The arrays of ``model``; the driver holds the rows of one order and part at a
        time beside them."""
        out = cls(langs, alphabet)
        for order, rows in model.items():
            for part in (0, 1):
                out._add(order, part, map_arrow(
                    rows.where(F.col("part") == part).select(
                        "lang", "gram", F.col("value").cast("float").alias("value")),
                    lambda b: _hash_of(b, langs), "code int, h long, value float").toArrow())
        return out

    def _add(self, order: int, part: int, rows: pa.Table) -> None:
        keys, row = np.unique(rows["h"].to_numpy().view(np.uint64), return_inverse=True)
        values = np.full((len(keys), len(self.langs)), float(part), np.float32)
        values[row, rows["code"].to_numpy()] = rows["value"].to_numpy()
        self.parts[order, part] = keys, values

    def _look(self, order: int, part: int, h: np.ndarray) -> np.ndarray:
        keys, values = self.parts.get((order, part), ((), None))
        if not len(keys):
            return np.full((len(h), len(self.langs)), float(part), np.float32)
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        return np.where((keys[at] == h)[:, None], values[at], np.float32(part))

    def log_p(self, cps: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log-probability of the characters at the places, a column a language."""
        p = np.full((len(at), len(self.langs)), self.floor, np.float64)
        here, before = gram_hashes(cps, at), gram_hashes(cps, at - 1)
        for k in range(1, ORDER + 1):
            p = self._look(k, 0, here[k]) + self._look(k, 1, before[k - 1]) * p
        return np.log(p)

    def remembered(self, h: np.ndarray, cps: np.ndarray, at: np.ndarray) -> np.ndarray:
        """``log_p`` at the places of distinct grams with the hashes ``h``; what earlier
        batches have computed is looked up."""
        if not hasattr(self, "known") or len(self.known[0]) > _KNOWN:
            self.known = h[:0], np.empty((0, len(self.langs)), np.float32)
        keys, values = self.known
        found, old = np.searchsorted(keys, h), np.zeros(len(h), bool)
        if len(keys):
            old = keys[np.minimum(found, len(keys) - 1)] == h
        out = np.empty((len(h), len(self.langs)), np.float32)
        out[old] = values[found[old]]
        out[~old] = self.log_p(cps, at[~old])
        new = np.flatnonzero(~old)[np.argsort(h[~old])]
        where = np.searchsorted(keys, h[new])
        self.known = np.insert(keys, where, h[new]), np.insert(values, where, out[new], axis=0)
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Characters of each text and its cross-entropy in each language."""
        cps, at, n = reduced(texts)
        out = np.zeros((len(texts), len(self.langs)))
        if len(at):
            h, one, kind = distinct_grams(cps, at)
            log_p = self.remembered(h, cps, at[one])
            some = n > 0
            starts = (np.cumsum(n) - n)[some]
            for j in range(len(self.langs)):
                out[some, j] = -np.add.reduceat(log_p[:, j][kind], starts,
                                                dtype=np.float64) / n[some]
        return n, out


_ENTROPIES = "chars long, entropies array<double>"


def _entropies(batch: pa.RecordBatch, models: Models):
    texts = batch.column("text").to_pylist()
    n, out = [], []
    for rows in batches(range(len(texts)), lambda i: len(texts[i] or ""), _CHARS):
        chars, entropies = models.entropies([texts[i] for i in rows])
        n += chars.tolist()
        out += entropies.tolist()
    names = [c for c in batch.schema.names if c != "text"]
    yield pa.RecordBatch.from_arrays(
        [*(batch.column(c) for c in names), pa.array(n, pa.int64()),
         pa.array(out, pa.list_(pa.float64()))], names=[*names, "chars", "entropies"])


def entropies_by_join(docs: DataFrame, model: dict[int, DataFrame], langs: list[str],
                      alphabet: int) -> DataFrame:
    """What the broadcast arrays give, for a model of any size: name, chars and
    entropies of each distinct document (name, text), by joins of gram counts with the
    model."""
    def single(value):
        return (F.col(value) if isinstance(value, str) else value).cast("float").cast("double")

    counts = written(gram_counts(docs.dropDuplicates(["name"]), "name"), "document-grams")
    names = F.array(*[F.lit(x) for x in langs])
    p = counts.select("gram").distinct().select("gram", F.explode(names).alias("lang"),
                                                F.lit(1.0 / (alphabet + 1)).alias("p"))
    for k in sorted(model):
        here = model[k].where("part = 0").select(
            "lang", F.col("gram").alias("g"), single("value").alias("a"))
        rest = model[k].where("part = 1").select(
            F.col("lang").alias("lang2"), F.col("gram").alias("c"), single("value").alias("b"))
        p = (p.withColumn("g", F.substring("gram", ORDER - k + 1, k))
             .withColumn("c", F.substring("gram", ORDER - k + 1, k - 1))
             .join(here, ["lang", "g"], "left").drop("g")
             .join(rest.withColumnRenamed("lang2", "lang"), ["lang", "c"], "left")
             .select("gram", "lang", (F.coalesce("a", F.lit(0.0)) + F.coalesce("b", F.lit(1.0))
                                      * F.col("p")).alias("p")))
    per = (counts.join(p, "gram").groupBy("name", "lang")
           .agg(F.sum("n").alias("chars"), (-F.sum(F.col("n") * single(F.log("p")))
                                           / F.sum("n")).alias("e")))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("lang", "e"))), lambda x: x["e"])
    return per.groupBy("name").agg(F.max("chars").alias("chars"), listed.alias("entropies"))


def train(docs: DataFrame) -> tuple[dict[int, DataFrame], list[str], int]:
    """The models of the learning rows of ``docs`` as a table an order, the languages in
    order, and the number of distinct characters."""
    learn = docs.where(~held_out() & F.col("lang").isNotNull())
    counts = written(gram_counts(learn, "lang"), "language-grams")
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    alphabet = counts.select(F.substring("gram", ORDER, 1).alias("c")).distinct().count()
    return kneser_ney(counts, langs), langs, alphabet


def scored(docs: DataFrame, model_rows: int = MODEL_ROWS) -> DataFrame:
    """Per row: doc_id, key, lang, held_out, chars, lang_pred, score and entropy (of
    the best language), written to the shared folder."""
    model, langs, alphabet = train(docs)
    rows = docs.select("doc_id", row_key().alias("key"), "lang", "text")
    n = sum(rows.count() for rows in model.values())
    models = None
    if n <= model_rows and n * len(langs) <= MODEL_CELLS:
        models = docs.sparkSession.sparkContext.broadcast(Models.of(model, langs, alphabet))
        kind = docs.schema["doc_id"].dataType.simpleString()
        out = map_arrow(rows, lambda b: _entropies(b, models.value),
                        f"doc_id {kind}, key long, lang string, {_ENTROPIES}")
    else:
        rows = rows.withColumn("name", F.concat_ws(":", "key", "doc_id"))
        per = entropies_by_join(rows.select("name", "text"), model, langs, alphabet)
        out = (rows.drop("text").join(per, "name", "left")
               .withColumn("chars", F.coalesce("chars", F.lit(0).cast("long"))))
    names = F.array(*[F.lit(x) for x in langs]) if langs else F.array().cast("array<string>")
    known = (F.col("chars") > 0) & F.lit(bool(langs))
    best = F.array_min("entropies")
    sharp = F.least("chars", F.lit(64)).cast("double")
    mass = F.aggregate("entropies", F.lit(0.0),
                       lambda s, e: s + F.exp(sharp * (F.array_min("entropies") - e)))
    found = written(out.select(
        "doc_id", "key", "lang", held_out().alias("held_out"), "chars",
        F.when(known, F.element_at(names, F.array_position("entropies", best).cast("int")))
        .otherwise(UNKNOWN).alias("lang_pred"),
        F.when(known, 1.0 / mass).otherwise(0.0).alias("score"),
        F.when(known, best).alias("entropy")), "languages")
    if models is not None:
        models.destroy()  # the scores are written, nothing reads it again
    return found


def identified(docs: DataFrame, model_rows: int = MODEL_ROWS) -> DataFrame:
    """``scored`` and the calibrated decision ``rejected``."""
    rows = scored(docs, model_rows).withColumn(
        "class", F.floor(F.log("chars") / F.log(F.lit(4.0))))
    classes = rows.where("NOT held_out AND lang = lang_pred").groupBy("lang_pred", "class").agg(
        F.count(F.lit(1)).alias("n"), F.avg("entropy").alias("mean"),
        F.stddev_pop("entropy").alias("spread")).where(F.col("n") >= FEW)
    limits = classes.select("lang_pred", "class", (
        F.col("mean") + SIGMAS * F.greatest("spread", F.lit(LEAST_SPREAD))).alias("limit"))
    widest = limits.groupBy("lang_pred").agg(F.max("limit").alias("widest"))
    most = limits.agg(F.max("limit")).first()[0]
    limit = F.coalesce("limit", "widest", F.lit(float("inf") if most is None else most))
    # a row a language and length class (32 at most), so the documents aren't shuffled
    return (rows.join(F.broadcast(limits), ["lang_pred", "class"], "left")
            .join(F.broadcast(widest), "lang_pred", "left")
            .withColumn("rejected", (F.col("lang_pred") == UNKNOWN) | (F.col("entropy") > limit))
            .drop("class", "limit", "widest"))


def keep_known(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that aren't rejected, with all their columns."""
    key, ident = fresh(docs, "_key", "_id")
    gone = identified(docs).where("rejected").select(
        F.col("key").alias(key), F.col("doc_id").alias(ident)).distinct()
    gone = written(gone, "rejected-languages")
    return docs.join(gone, (row_key() == gone[key]) & docs["doc_id"].eqNullSafe(gone[ident]),
                     "left_anti")


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return identified(documents(spark, sf_dir)).select(
        "doc_id", "held_out", "lang_pred", "score", "entropy", "rejected")
