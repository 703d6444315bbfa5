"""Spark helpers shared by the corpus operators."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import apply_unset, scratch_dir

BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
           "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}
SPACE_RUN = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, lineage
    cut, and safe from the loss of executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name in taken:
            name += "_"
        taken.add(name)
        out.append(name)
    return out


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """64-bit key of a row's id and text. With the id beside it, it tells rows
    apart; rows with the same id and the same text share it."""
    return F.xxhash64(F.col(doc_id), F.col(text))


def ship(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per application, and bound the
    batches they get (unless set at launch): texts may be long."""
    sc = spark.sparkContext
    if not getattr(sc, "_llm_shipped", False):
        package = Path(__file__).resolve().parents[1]
        sc.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip",
                                         package.parent, package.name))
        apply_unset(spark, BATCHES)
        sc._llm_shipped = True


def tasks(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
          schema: str) -> DataFrame:
    """``run`` over the Arrow batches of each partition of ``df``."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``fn`` over each Arrow batch of ``df``."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            yield from fn(batch)

    return tasks(df, run, schema)


def longs(values: np.ndarray) -> pa.Array:
    """Unsigned 64-bit values as Spark longs (same bits)."""
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def record(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c)
         for c in columns.values()], names=list(columns))


class Bloom:
    """Bloom filter over well-mixed 64-bit hashes, of at most ``MAX_BITS`` bits
    (16 MiB) whatever the data: the only thing the operators ship to every task.
    Beyond that size it lets more hashes through; what it lets through is always
    checked exactly by a join, so a full filter costs time and not rows."""

    MAX_BITS = 1 << 27

    def __init__(self, cells: np.ndarray, bits: int):
        self.cells, self.bits = cells, bits

    @classmethod
    def of(cls, df: DataFrame, column: str) -> "Bloom":
        """Filter of a long column. The bits are set on Spark; the driver gets one
        row per filled 64-bit cell. Nulls are not in it."""
        bits = 1 << 12
        n = df.count()
        while bits < min(16 * n, cls.MAX_BITS):
            bits *= 2
        cells = np.zeros(bits // 64, np.uint64)
        filled = (
            df.where(F.col(column).isNotNull())
            .select(F.explode(F.array(
                F.col(column).bitwiseAND(F.lit(bits - 1)),
                F.shiftrightunsigned(column, 32).bitwiseAND(F.lit(bits - 1)))).alias("at"))
            .groupBy(F.shiftright("at", 6).alias("cell"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 AS INT)))").alias("set"))
            .toArrow())
        cells[filled["cell"].to_numpy()] = filled["set"].to_numpy().view(np.uint64)
        return cls(cells, bits)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        low = np.uint64(self.bits - 1)
        out = np.ones(len(hashes), bool)
        for at in (hashes & low, (hashes >> np.uint64(32)) & low):
            cell = self.cells[(at >> np.uint64(6)).astype(np.int64)]
            out &= ((cell >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)
        return out
