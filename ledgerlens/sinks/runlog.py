"""K4 — the run log: one row per report run, appended to ``{root}/run_log``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("report", T.StringType()),
    T.StructField("rows_returned", T.LongType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("output_root", T.StringType()),
    T.StructField("run_date", T.DateType()),
    T.StructField("exported", T.BooleanType()),
    T.StructField("logged_at", T.TimestampType()),
])


def run_log_row(spark: SparkSession, status: str, report: str, rows: int, table_name: str,
                output_root: str, run_date: dt.date, exported: bool,
                logged_at: dt.datetime | None = None) -> DataFrame:
    logged_at = logged_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return spark.createDataFrame(
        [(status, report, rows, table_name, output_root, run_date, exported, logged_at)],
        RUN_LOG_SCHEMA)


def append_run_log(row: DataFrame, root: str) -> None:
    row.write.mode("append").parquet(f"{root.rstrip('/')}/run_log")
