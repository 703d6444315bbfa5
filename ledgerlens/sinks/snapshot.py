"""K1 — dated snapshot of a report: ``{root}/{report}_{YYYYMMDD}``, replaced as a whole.

A snapshot is a :class:`~ledgerlens.sinks.versions.Versioned` folder: a run that is
repeated on its day writes a new version and publishes it when it is complete, so a
failed run leaves the day's last good snapshot readable. An empty result publishes
nothing, so the previous snapshot of that name stays. The rows are counted by the write
itself (K4): no job counts them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.sinks.versions import Version, Versioned


def snapshot_name(report: str, run_date: dt.date) -> str:
    return f"{report}_{run_date:%Y%m%d}"


def _table(spark: SparkSession, root: str, report: str, run_date: dt.date) -> Versioned:
    return Versioned(spark, f"{root.rstrip('/')}/{snapshot_name(report, run_date)}")


def snapshot(df: DataFrame, root: str, report: str, run_date: dt.date) -> Version | None:
    """Replace the dated snapshot; return its path and rows, or None when ``df`` is empty."""
    return _table(df.sparkSession, root, report, run_date).write(df, empty=False)


def read_snapshot(spark: SparkSession, root: str, report: str, run_date: dt.date) -> DataFrame:
    """The dated snapshot as last published; raises where there is none."""
    return _table(spark, root, report, run_date).read()
