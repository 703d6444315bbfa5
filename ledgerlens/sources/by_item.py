"""The sales lines stored by item: history and lines meet where they lie (J7, A9).

A second copy of the history, bucketed and sorted by (item, part). An ordinary item is
one part, so its lines are in one bucket and their maxima are taken there: neither the
aggregation nor the join back to the lines moves a row. An item with more than
``PART_ROWS`` lines is dealt over as many parts as it has that many lines, in buckets of
their own; its maxima are one row a part, which are put together in a shuffle of those
few rows. Lines without an item meet nothing and are dealt over the buckets. Parts are
dealt by a hash of the line, so a task that runs again deals as before; lines that are
alike in every column stay in one part.

The copy is replaced as a whole; the file that names the current one is replaced in one
rename (:mod:`ledgerlens.sinks.versions`).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import schemas as S
from ledgerlens.operators.filters import NO_FILTER, RunFilter
from ledgerlens.operators.items import NULL_ITEM_SALTS
from ledgerlens.functions.columns import with_partner_id
from ledgerlens.session import stored
from ledgerlens.sinks.versions import POINTER, Files

BUCKETS, PART_ROWS = 64, 1_000_000


class SalesByItem:
    """The copy at ``root``. ``buckets`` should make a bucket fit a sort-merge task."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS,
                 part_rows: int = PART_ROWS):
        self.spark, self.root = spark, root.rstrip("/")
        self.buckets, self.part_rows = buckets, part_rows
        self.files = Files(spark, self.root)
        self.at = json.loads(self.files.read(f"{self.root}/{POINTER}") or "{}")

    def write(self, sales: DataFrame) -> None:
        """Replace the copy by ``sales``. Items are counted first (partial counts in the
        tasks); the few with several parts meet the lines in a join whose size is
        measured."""
        sales = with_partner_id(sales)
        many = stored(sales.where("item_id IS NOT NULL").groupBy(F.col("item_id").alias("_item"))
                      .count().where(F.col("count") > self.part_rows)
                      .select("_item", F.ceil(F.col("count") / self.part_rows).cast("int")
                              .alias("_parts")), "items-of-parts")
        spread = F.xxhash64(*[c for c in sales.columns if c != "item_id"])
        dealt = (sales.join(many, F.col("item_id") == F.col("_item"), "left")
                 .withColumn("item_parts", F.coalesce("_parts", F.lit(1)))
                 .withColumn("item_part", F.when(
                     F.col("item_id").isNull(), F.pmod(spread, F.lit(NULL_ITEM_SALTS)))
                     .otherwise(F.pmod(spread, F.col("item_parts"))).cast("int"))
                 .drop("_item", "_parts"))
        name = f"sales_by_item_{uuid.uuid4().hex}"
        keys = ("item_id", "item_part")
        (dealt.repartition(self.buckets, *keys).write.format("parquet")
         .bucketBy(self.buckets, *keys).sortBy(*keys)
         .option("compression", "zstd").option("path", f"{self.root}/versions/{name}").saveAsTable(name))
        old = self.at
        at = {"name": name, "buckets": self.buckets, "before": old.get("name"),
              "columns": self.spark.table(name).schema.json()}
        self.files.replace(f"{self.root}/{POINTER}", json.dumps(at))
        self.at = at
        if old.get("before"):
            self.spark.sql(f"DROP TABLE IF EXISTS {old['before']}")
            self.files.delete(f"{self.root}/versions/{old['before']}")

    def lines(self) -> DataFrame:
        """The stored lines, with ``item_part`` and ``item_parts``."""
        name = self.at["name"]
        if not self.spark.catalog.tableExists(name):
            fields = T.StructType.fromJson(json.loads(self.at["columns"])).fields
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (item_id, item_part) "
                f"SORTED BY (item_id, item_part) INTO {self.at['buckets']} BUCKETS "
                f"LOCATION '{self.root}/versions/{name}'")
        return self.spark.table(name)

    def consolidated_items(self, run_filter: RunFilter = NO_FILTER) -> DataFrame:
        """A9 of the run's lines: as :func:`items.consolidated_items`, read by bucket."""
        base = run_filter.apply(self.lines())
        maxima = (base.where("item_id IS NOT NULL").groupBy("item_id", "item_part")
                  .agg(F.max("gross_amount").alias("_gross"),
                       F.max("collected_amount").alias("_collected")))
        # stored, so that the join knows how few they are and leaves the lines in place
        whole = stored(base.where("item_id IS NOT NULL AND item_parts > 1")
                       .groupBy(F.col("item_id").alias("_item"))
                       .agg(F.max("gross_amount").alias("_all_gross"),
                            F.max("collected_amount").alias("_all_collected")),
                       "maxima-of-parts")
        joined = (base.join(maxima.hint("merge"), ["item_id", "item_part"], "left")
                  .join(whole, F.col("item_id") == F.col("_item"), "left"))
        canceled = F.col("item_status") == S.STATUS_CANCELED

        def amount(own: str, most: str) -> F.Column:
            best = F.when(F.col("_item").isNotNull(), F.col(f"_all_{most}")).otherwise(
                F.col(f"_{most}"))
            back = F.when(F.col("item_id").isNotNull(), F.coalesce(-best, F.lit(0)))
            return F.when(canceled, back).otherwise(F.col(own))

        return joined.select(
            "item_id", "item_status", "session_id", "invoice_id",
            amount("gross_amount", "gross").alias("gross_transaction"),
            amount("collected_amount", "collected").alias("collected"))
