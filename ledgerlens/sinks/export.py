"""K2 — formatted text export of a report (header row + formatted rows).

The source system overwrote a spreadsheet tab; here the grid is a CSV folder,
fully overwritten. An empty report writes nothing (the previous export stays).
Rows keep the report's order: the writer emits the sorted partitions in order,
so no single-task coalesce is needed. The folder is one dataset of part files,
each with the header, as Spark's CSV reader (``header=true``) expects it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.functions.cells import report_cells
from ledgerlens.session import ensure_checkpoint_dir


def export_cells(df: DataFrame, path: str, legacy_strings: bool = False,
                 rows: int | None = None) -> bool:
    """Write ``df`` as formatted text cells; return False when nothing was written.
    ``rows`` spares the emptiness check a caller who has counted; without it the report
    is checkpointed, so that the check doesn't compute it a second time."""
    if rows is None:
        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint()
    if df.isEmpty() if rows is None else not rows:
        return False
    (report_cells(df, legacy_strings).write.mode("overwrite")
     .option("header", True).option("emptyValue", "").csv(path))
    return True


def read_cells(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """An export read back: text cells, empty ones as empty text."""
    cells = spark.read.schema(", ".join(f"`{c}` string" for c in columns)).csv(path, header=True)
    return cells.fillna("")
