"""A8 and A12 carried from day to day: the settlement state.

The audited job reads its whole history every day. This state takes in one day's lines
and recomputes only the items they touch:

* ``lines``: per (settlement group, item, status) and day the count, sums and maxima of
  the lines, in tables bucketed and sorted by item. It is read by bucket, so a day's
  items meet their past without a shuffle of that past;
* ``groups``: what each day changed in the groups' measures. Measures are sums, so a
  group's value is the sum of its changes; NULL is a measure none of whose terms has a
  value, so the number of terms with one is kept beside each sum.

Taking in a day: its lines are dealt by item and aggregated; the items in them, and those
of an earlier load of the same day, are looked up in the past; the terms of these items'
rows are computed as they were and as they are now, and where they differ the groups'
differences are appended. All of it runs where the buckets lie: what is shuffled is the
day's lines, once, and the differences summed by group.
A day that is taken in again replaces its earlier lines, whether or not they changed.

What is current is said by a small file that is replaced in one rename after everything
was written (:mod:`ledgerlens.sinks.versions`): a load that fails changes nothing. Every
``KEEP`` loads the tables are merged into one each, without the rows of replaced loads.

Rows without an item or status meet no other line. They are spread over the buckets by
their group.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators.items import (
    SETTLEMENT_KEYS, SETTLEMENT_MEASURES, item_status_rows, reversal, settlement_terms)
from ledgerlens.sinks.versions import POINTER, Files

BUCKETS, KEEP = 64, 8
# an item with more lines in a day is summed before the day's lines are dealt
HOT_LINES = 1_000_000
_ROW_KEYS = (*SETTLEMENT_KEYS, "item_id", "item_status")


def _in_place(rows: DataFrame, name: str = "lies") -> DataFrame:
    """``rows`` with their bucket under another ``name``: Spark sees that the parts of a
    union are dealt alike, and leaves them in place, if each renames the column."""
    return rows.withColumnRenamed("lies" if "lies" in rows.columns else "bucket", name)


class SettlementState:
    """The state at ``root``, created by the first load. ``buckets`` is fixed by the
    first load: size it so that a bucket of ``lines`` fits one sort-merge task."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS, keep: int = KEEP,
                 hot_lines: int = HOT_LINES):
        self.spark, self.root, self.keep = spark, root.rstrip("/"), keep
        self.hot_lines = hot_lines
        self.files = Files(spark, self.root)
        self.at = json.loads(self.files.read(f"{self.root}/{POINTER}") or "null") or {
            "buckets": buckets, "loads": {}, "lines": [], "groups": []}

    # -- tables -----------------------------------------------------------------------

    def _publish(self, **changes) -> None:
        at = {**self.at, **changes}
        self.files.replace(f"{self.root}/{POINTER}", json.dumps(at))
        self.at = at

    def _rows(self, sales: DataFrame) -> DataFrame:
        """:func:`items.item_status_rows` of a day with their bucket, dealt by it.

        The lines are dealt and summed where they then lie: one shuffle. If an item has
        more than ``hot_lines`` lines, or as many have none, they are summed first, so
        that its lines collapse in the tasks that read them."""
        spread = F.coalesce("item_id", F.xxhash64(*SETTLEMENT_KEYS, "item_status"))
        lines, buckets = sales.withColumn("bucket", spread), self.at["buckets"]
        hot = sales.groupBy("item_id").count().where(F.col("count") > self.hot_lines)
        if hot.isEmpty():
            return item_status_rows(lines.repartition(buckets, "bucket"), "bucket")
        return item_status_rows(lines, "bucket").repartition(buckets, "bucket")

    def _write_lines(self, rows: DataFrame) -> dict:
        """``rows``, dealt by bucket, as a bucketed table; its folder and its columns."""
        name = f"settlement_lines_{uuid.uuid4().hex}"
        folder = f"{self.root}/lines/{name}"
        (rows.write.format("parquet").bucketBy(self.at["buckets"], "bucket").sortBy("bucket")
         .option("compression", "zstd").option("path", folder).saveAsTable(name))
        return {"name": name, "columns": self.spark.table(name).schema.json()}

    def _bucketed(self, table: dict) -> DataFrame:
        """A table of ``lines``, made known to this session's catalog if it isn't."""
        name = table["name"]
        if not self.spark.catalog.tableExists(name):
            schema = T.StructType.fromJson(json.loads(table["columns"]))
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (bucket) "
                f"SORTED BY (bucket) INTO {self.at['buckets']} BUCKETS "
                f"LOCATION '{self.root}/lines/{name}'")
        return self.spark.table(name)

    def _live(self, rows: DataFrame, loads: dict[str, str]) -> DataFrame:
        return rows.where(F.col("load").isin(list(loads.values())))

    def _past(self, items: DataFrame) -> DataFrame | None:
        """The live rows of ``items`` (bucket: item ids), table by table so that each is
        read by its buckets."""
        out = None
        for table in self.at["lines"]:
            rows = self._live(self._bucketed(table), self.at["loads"]).where("item_id IS NOT NULL")
            met = _in_place(rows.join(items, "bucket", "left_semi"))
            out = met if out is None else out.unionByName(met)
        return out

    # -- loading ----------------------------------------------------------------------

    def ingest(self, day: dt.date | str, sales: DataFrame) -> None:
        """Take in the lines of ``day`` in place of any it had."""
        day, load = str(day), uuid.uuid4().hex
        replaced = self.at["loads"].get(day)
        table = self._write_lines(self._rows(sales).withColumn("load", F.lit(load)))
        new = _in_place(self._bucketed(table))
        before = None
        for old in self.at["lines"] if replaced else ():
            rows = _in_place(self._bucketed(old).where(F.col("load") == replaced))
            before = rows if before is None else before.unionByName(rows)

        touched = new if before is None else new.unionByName(before)
        items = (touched.where("item_id IS NOT NULL").select("lies").distinct()
                 .withColumnRenamed("lies", "bucket"))
        past = self._past(items)
        was = past
        if before is not None:  # its rows without an item are no item's past
            was = past.unionByName(before.where("item_id IS NULL"))
        now = new
        if past is not None:
            kept = past if not replaced else past.where(F.col("load") != replaced)
            now = new.unionByName(kept)
        change = self._measures(now, 1)
        if was is not None:
            change = change.unionByName(self._measures(was, -1))
        folder = f"{self.root}/groups/{load}"
        self._summed(self._changed(change)).write.parquet(folder)
        self._publish(loads={**self.at["loads"], day: load}, lines=[*self.at["lines"], table],
                      groups=[*self.at["groups"], folder])
        if len(self.at["lines"]) > self.keep:
            self.merge()

    def _measures(self, rows: DataFrame, sign: int) -> DataFrame:
        """The terms of ``rows``, with the days of a row merged first, times ``sign``."""
        merged = rows.groupBy("lies", *_ROW_KEYS).agg(*[
            F.expr(f"CAST({'max' if c.startswith('max_') else 'sum'}({c}) AS {kind}) AS {c}")
            for c, kind in rows.select(*_MEASURED).dtypes])
        terms = settlement_terms(merged, "lies")
        return _in_place(terms.selectExpr("lies", *_ROW_KEYS, *[
            f"CAST({c} * {sign} AS {kind}) AS {c}" for c, kind in terms.dtypes
            if c not in ("lies", *_ROW_KEYS)]), "place")

    def _changed(self, terms: DataFrame) -> DataFrame:
        """The differences of the rows that have any: those that are now as they were
        needn't reach the groups."""
        measures = [(c, kind) for c, kind in terms.dtypes if c not in ("place", *_ROW_KEYS)]
        rows = terms.groupBy("place", *_ROW_KEYS).agg(*[
            F.expr(f"CAST(sum({c}) AS {kind}) AS {c}") for c, kind in measures])
        return (rows.where(" OR ".join(f"{c} != 0" for c, _ in measures))
                .select(*SETTLEMENT_KEYS, *[c for c, _ in measures]))

    def _summed(self, changes: DataFrame) -> DataFrame:
        return changes.groupBy(*SETTLEMENT_KEYS).agg(*[
            F.expr(f"CAST(sum({c}) AS {kind}) AS {c}") for c, kind in changes.dtypes
            if c not in SETTLEMENT_KEYS])

    def merge(self) -> None:
        """Merge the tables into one each; replaced loads go, and the old tables after
        the merged ones are current."""
        lines, groups = self.at["lines"], self.at["groups"]
        rows = None
        for table in lines:
            part = self._live(self._bucketed(table), self.at["loads"])
            rows = part if rows is None else rows.unionByName(part)
        folder = f"{self.root}/groups/{uuid.uuid4().hex}"
        self._summed(self.spark.read.parquet(*groups)).write.parquet(folder)
        dealt = rows.repartition(self.at["buckets"], "bucket")
        self._publish(lines=[self._write_lines(dealt)], groups=[folder])
        for table in lines:
            self.spark.sql(f"DROP TABLE IF EXISTS {table['name']}")
            self.files.delete(f"{self.root}/lines/{table['name']}")
        for old in groups:
            self.files.delete(old)

    # -- reading ----------------------------------------------------------------------

    def settlement_lines(self) -> DataFrame:
        """A12 over all days: as :func:`items.settlement_lines` over all their lines."""
        sums = self._summed(self.spark.read.parquet(*self.at["groups"])).where("lines > 0")
        return sums.selectExpr(*SETTLEMENT_KEYS, *[
            f"CASE WHEN {m}_terms > 0 THEN {m} END AS {m}" for m in SETTLEMENT_MEASURES])

    def item_history(self) -> DataFrame:
        """A8 over all days: as :func:`items.item_history`. The tables are read by their
        buckets, so an item's maxima are found where it lies; only the lines without an
        item, one row a bucket, are put together by a shuffle."""
        out = None
        for table in self.at["lines"]:
            part = _in_place(self._live(self._bucketed(table), self.at["loads"]).select(
                "bucket", "item_id", "max_gross", "max_collected"))
            out = part if out is None else out.unionByName(part)
        back = (reversal("max_gross").alias("hist_gross"),
                reversal("max_collected").alias("hist_collected"))
        items = out.where("item_id IS NOT NULL").groupBy("lies", "item_id").agg(*back)
        rest = out.where("item_id IS NULL").groupBy("item_id").agg(*back)
        return items.drop("lies").unionByName(rest)


_MEASURED = ("n", "sum_gross", "max_gross", "sum_collected", "max_collected", "commission")
