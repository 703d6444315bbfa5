"""L1-L3 as a kept index: look a key up without reading the history.

The index holds, for every contract and partner spelling and for every partner and
contract, the latest ``period_to`` of their lines: a few rows a key, in tables bucketed
by that key, so a lookup reads one bucket. New lines are merged in: their pairs are
aggregated (a key that holds a third of the lines collapses in the tasks) and the later
date of old and new stays. Merging the same lines again changes nothing.

Each merge writes new tables and publishes them by replacing one small file
(:mod:`ledgerlens.sinks.versions`); a merge that fails leaves the index as it was. The
tables before the current ones are kept for readers that have opened them.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.columns import with_partner_id
from ledgerlens.sinks.versions import POINTER, Files

BUCKETS = 64
#: table -> (key, its type, value, its type)
PAIRS = {"by_contract": ("contract_code", "string", "partner_raw", "string"),
         "by_partner": ("partner_id", "bigint", "contract_code", "string")}


class LookupIndex:
    """The index at ``root``, created by the first merge. ``buckets`` is fixed by the
    first merge; a bucket should fit one task."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = Files(spark, self.root)
        self.at = json.loads(self.files.read(f"{self.root}/{POINTER}") or "null") or {
            "buckets": buckets, "version": None, "before": None}

    def _folder(self, version: str) -> str:
        return f"{self.root}/versions/{version}"

    def _table(self, name: str, version: str) -> DataFrame:
        """A table of the index, made known to this session's catalog if it isn't."""
        table = f"lookup_{name}_{version}"
        if not self.spark.catalog.tableExists(table):
            key, key_type, value, value_type = PAIRS[name]
            self.spark.sql(
                f"CREATE TABLE {table} ({key} {key_type}, {value} {value_type}, period_to date) "
                f"USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
                f"INTO {self.at['buckets']} BUCKETS LOCATION '{self._folder(version)}/{name}'")
        return self.spark.table(table)

    def pairs(self, name: str) -> DataFrame:
        """(key, value, latest period_to) of ``by_contract`` or ``by_partner``."""
        key, key_type, value, value_type = PAIRS[name]
        if self.at["version"] is None:
            return self.spark.createDataFrame(
                [], f"{key} {key_type}, {value} {value_type}, period_to date")
        return self._table(name, self.at["version"])

    def merge(self, sales: DataFrame) -> None:
        """Take in lines. The index's side of the merge is read by bucket."""
        version = uuid.uuid4().hex
        lines = with_partner_id(sales)
        for name, (key, _, value, _) in PAIRS.items():
            new = lines.where(F.col(key).isNotNull())
            if name == "by_partner":  # a partner's contract is never NULL
                new = new.where(F.col(value).isNotNull())
            latest = new.groupBy(key, value).agg(F.max("period_to").alias("period_to"))
            both = self.pairs(name).unionByName(latest).groupBy(key, value).agg(
                F.max("period_to").alias("period_to"))
            (both.repartition(self.at["buckets"], key).write.format("parquet")
             .bucketBy(self.at["buckets"], key).sortBy(key)
             .option("path", f"{self._folder(version)}/{name}")
             .saveAsTable(f"lookup_{name}_{version}"))
        old = self.at
        at = {"buckets": old["buckets"], "version": version, "before": old["version"]}
        self.files.replace(f"{self.root}/{POINTER}", json.dumps(at))
        self.at = at
        if old["before"]:
            for name in PAIRS:
                self.spark.sql(f"DROP TABLE IF EXISTS lookup_{name}_{old['before']}")
            self.files.delete(self._folder(old["before"]))

    # -- lookups, as in operators.lookups ----------------------------------------------

    def _latest(self, name: str, key_value) -> DataFrame:
        key, _, value, _ = PAIRS[name]
        return (self.pairs(name).where(F.col(key) == F.lit(key_value))
                .orderBy(F.col("period_to").desc_nulls_last(), F.col(value).desc_nulls_last())
                .limit(1).select(value))

    def partner_for_contract(self, contract_code: str) -> DataFrame:
        """L1: the partner (as spelt in the data) of the latest line of a contract."""
        return self._latest("by_contract", contract_code)

    def contract_for_partner(self, partner_id: int) -> DataFrame:
        """L2: the latest non-NULL contract of a partner."""
        return self._latest("by_partner", int(partner_id))

    def contracts_of_partner(self, partner_id: int) -> DataFrame:
        """L3: distinct non-NULL contracts of a partner, ascending."""
        return (self.pairs("by_partner").where(F.col("partner_id") == F.lit(int(partner_id)))
                .select("contract_code").distinct().orderBy("contract_code"))

    def _every(self, name: str) -> DataFrame:
        key, _, value, _ = PAIRS[name]
        return (self.pairs(name).groupBy(key).agg(F.max(F.struct("period_to", value)).alias("top"))
                .select(key, F.col(f"top.{value}").alias(value)))

    def latest_partner_by_contract(self) -> DataFrame:
        """L1 for every contract; each key's pairs are in one bucket: no shuffle."""
        return self._every("by_contract")

    def latest_contract_by_partner(self) -> DataFrame:
        """L2 for every partner; no shuffle."""
        return self._every("by_partner")
