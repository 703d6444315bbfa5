"""Exact dedup (operator 3): a persistent digest index.

``DigestIndex`` is a Parquet table in a shared folder, bucketed and sorted by the
SHA-256 of the normalised text, with one row per known text: the digest and the
id of the document that stands for it. New data is grouped by digest (partial
aggregation: a text with a third of all rows collapses before the shuffle),
anti-joined with the index by a sort-merge join that reads the index bucket by
bucket without a shuffle, and what is new is appended. Ingesting the same data
again adds nothing, so a job that died half-way may simply be run again. Rows find
their group by a join on the digest; texts with over a thousandth of the rows each,
a thousand at most, are broadcast to their rows instead.

Defined results: a null text counts as the empty text, and empty texts are equal.
Of equal texts in one batch the row with the smallest doc_id stands for all (a
null doc_id comes last); a text that the index had before belongs to the earlier
batch. Of rows that repeat both doc_id and text one is kept. An empty table gives
no rows. Only the id and text columns are read; others pass through ``dedup``
whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.frames import SPACE_RUN, documents, fresh, written
from ledgerlens.session import scratch_dir


#: a text with more than one in so many rows is hot; there can't be more hot texts than this
HOT_TEXTS = 1000


def digest(text: Column) -> Column:
    """SHA-256 (32 bytes) of the text with each run of white space as one space."""
    normal = F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")
    return F.unhex(F.sha2(normal.cast("binary"), 256))


class DigestIndex:
    """The index at ``path``, created when there is none. ``buckets`` (by default the
    number of shuffle partitions) must be the same whenever the index is opened; size
    it so that a bucket's digests fit one sort-merge task."""

    def __init__(self, spark: SparkSession, path: str, id_type: str = "bigint",
                 buckets: int | None = None):
        self.spark, self.path = spark, path
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.buckets = buckets
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} (digest BINARY, keep_id {id_type}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS "
            f"LOCATION '{path}'")

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def ingest(self, groups: DataFrame) -> None:
        """Append the digests of ``groups`` (digest, keep_id; one row per digest)
        that the index doesn't have."""
        new = groups.select("digest", "keep_id").hint("merge").join(
            self.rows().select("digest").hint("merge"), "digest", "left_anti")
        (written(new, "digest-new").repartition(self.buckets, "digest")
         .sortWithinPartitions("digest")
         .write.insertInto(self.name))
        self.spark.catalog.refreshTable(self.name)

    def forget(self) -> None:
        """Drop the name from this session's catalog; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def groups_of(digests: DataFrame) -> DataFrame:
    """Per digest: its smallest non-null doc_id and its number of rows."""
    return digests.groupBy("digest").agg(F.min("doc_id").alias("keep_id"),
                                         F.count(F.lit(1)).alias("group_size"))


def decide(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """Ingest ``docs`` (doc_id, text) and return per row: doc_id, digest, keep_id,
    group_size (rows with the text in ``docs``) and kept."""
    first = F.row_number().over(Window.partitionBy("doc_id", "digest").orderBy(F.lit(1))) == 1
    digests = written(docs.select("doc_id", digest(F.col("text")).alias("digest"))
                      .withColumn("first", first), "digests")
    groups = written(groups_of(digests), "digest-groups")
    index.ingest(groups)
    kept = written(index.rows().join(groups.select("digest", "group_size"), "digest"),
                   "digest-kept")
    # the few digests with many rows are looked up where the rows are; equal digests
    # compress so well that a join's partitions would not look uneven to AQE
    many = digests.count() / HOT_TEXTS
    hot = F.broadcast(kept.where(F.col("group_size") > many))
    found = digests.join(hot, "digest").unionByName(
        digests.join(hot.select("digest"), "digest", "left_anti")
        .join(kept.where(F.col("group_size") <= many), "digest"))
    return found.withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("keep_id")) & F.col("first")).drop("first")


def dedup(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    spark = docs.sparkSession
    index = DigestIndex(spark, scratch_dir(spark, "digest-index"),
                        docs.schema["doc_id"].dataType.simpleString())
    rows = written(decide(docs, index), "digest-decisions")
    key, same_key, keep, n = fresh(docs, "_digest", "_digest_kept", "_keep", "_rows")
    same = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    keepers = rows.where(same).groupBy("digest", "keep_id").agg(F.count(F.lit(1)).alias("n"))
    keepers = keepers.select(F.col("digest").alias(same_key), F.col("keep_id").alias(keep),
                             F.col("n").alias(n))
    out = docs.withColumn(key, digest(F.col("text"))).join(
        keepers, (F.col(key) == F.col(same_key)) & F.col("doc_id").eqNullSafe(F.col(keep)))
    if not keepers.where(F.col(n) > 1).isEmpty():  # rows that repeat id and text
        once = F.row_number().over(Window.partitionBy(key, "doc_id").orderBy(F.lit(1)))
        rank, = fresh(out, "_rank")
        out = out.withColumn(rank, once).where(F.col(rank) == 1)
    return out.select(docs.columns)


def op3_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group, decision and text digest, by way of a fresh index."""
    docs = documents(spark, sf_dir)
    index = DigestIndex(spark, scratch_dir(spark, "digest-index"),
                        docs.schema["doc_id"].dataType.simpleString())
    return decide(docs, index).select(
        "doc_id", "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"))


OP3_SQL = r"""
WITH t AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
    FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM t WINDOW g AS (PARTITION BY norm)
"""
