"""Cell formatting, dated snapshots, the text export and the report job."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import fee, make_tables, sale, tax

from ledgerlens.functions.cells import report_cells
from ledgerlens.job import run
from ledgerlens.operators.filters import RunFilter
from ledgerlens.session import scratch_dir
from ledgerlens.sinks.export import export_cells, read_cells
from ledgerlens.sinks.snapshot import read_snapshot, snapshot, snapshot_name
from ledgerlens.sinks.versions import Versioned


def test_cell_rules(spark):
    schema = T.StructType([
        T.StructField("partner_id", T.LongType()), T.StructField("amount", T.DecimalType(20, 4)),
        T.StructField("label", T.StringType()), T.StructField("day", T.DateType()),
        T.StructField("n", T.LongType())])
    df = spark.createDataFrame([
        (1234, D("12.3"), "text", dt.date(2024, 1, 31), 5),
        (None, None, "", None, None),
        (7, D("0.125"), "70123", None, -2),
        (8, D("-2.675"), "inv/1", None, 0),
        (9, D("2.6751"), "1_000", None, 7),
    ], schema)
    got = [tuple(r) for r in report_cells(df).collect()]
    assert got == [("1234", "12.30", "text", "2024-01-31", "5.00"),
                   ("", "", "", "", ""),
                   ("7", "0.12", "70123", "", "-2.00"),      # a tie: half to even
                   ("8", "-2.67", "inv/1", "", "0.00"),      # below the tie as a double
                   ("9", "2.68", "1_000", "", "7.00")]
    legacy = [r.label for r in report_cells(df, legacy_strings=True).collect()]
    assert legacy == ["text", "", "70123.00", "inv/1", "1000.00"]


def test_doubles_print_as_their_exact_value(spark):
    """Against the language's own formatting: ties, values beside ties, fine fractions,
    carries, large values, signs and special values."""
    rng = random.Random(4)
    values = [0.125, 0.375, 2.675, 1.005, 0.005, 0.015, 0.995, 9.995, 99.995, 0.0, -0.0, -0.001,
              -0.005, 1e-300, 5e-324, 0.5, 1.5, 2 ** 52 + 0.5, 2.0 ** 52 - 0.5, 2.0 ** 53 + 2, 1e15 + 0.125,
              1e15 + 0.375, 4503599627370495.5, 9.2e18, 2.0 ** 63, 1e19, 1.2345e25, 7e37, -3e30,
              float("inf"), float("-inf"), float("nan")]
    values += [k / 8 + s for k in range(0, 40) for s in (0, 1e9, 123456)]
    values += [(2 * k + 1) / 200 for k in range(200)]  # what looks like a tie in decimals
    values += [math.nextafter(v, d) for v in (0.125, 0.375, 0.005, 5.625) for d in (0, 10)]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-6, 17) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.v for r in report_cells(df).collect()]
    assert got == [f"{v:.2f}" for v in values]


def test_numeric_text_by_the_grammar_of_the_source(spark):
    texts = ["1_000", "1__0", "_1", "1_", " 12 ", "7.", ".5", "-.5e1", "1e3", "1e_3", "1_0e1_0", "+4",
             "nan", "-NaN", "inf", "-Infinity", "infin", "1d", "0x10", "1,000", "--1", "1e400", "e5",
             ".", "", "2.675", "1_0.2_5"]

    def source(text):
        try:
            return f"{float(text):.2f}" if text else ""
        except ValueError:
            return text

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.t for r in report_cells(df, legacy_strings=True).collect()]
    assert got == [source(t) for t in texts]


def test_snapshot_and_export_skip_empty_results(spark):
    root = scratch_dir(spark, "empty")
    day = dt.date(2024, 1, 2)
    empty = spark.createDataFrame([], "a int")
    assert snapshot(empty, root, "partner_summary", day) is None
    assert export_cells(empty, f"{root}/export") is False
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, root, "partner_summary", day)
    snapshot(spark.createDataFrame([(1,)], "a int"), root, "partner_summary", day)
    assert snapshot(empty, root, "partner_summary", day) is None
    assert [r.a for r in read_snapshot(spark, root, "partner_summary", day).collect()] == [1]


def test_snapshot_replaces_dated_table(spark):
    root = scratch_dir(spark, "snap")
    day = dt.date(2024, 3, 9)
    first = snapshot(spark.createDataFrame([(1,), (2,)], "a int"), root, "invoice_summary", day)
    assert "/invoice_summary_20240309/" in first.path and first.rows == 2
    opened = spark.read.parquet(first.path)  # a reader that found the first version
    snapshot(spark.createDataFrame([(3,)], "a int"), root, "invoice_summary", day)
    assert [r.a for r in read_snapshot(spark, root, "invoice_summary", day).collect()] == [3]
    assert sorted(r.a for r in opened.collect()) == [1, 2]
    snapshot(spark.createDataFrame([(4,)], "a int"), root, "invoice_summary", day)
    assert len(glob.glob(f"{root}/invoice_summary_20240309/versions/*")) == 2
    assert not os.path.exists(first.path)
    assert snapshot_name("x", day) == "x_20240309"


def test_a_failed_write_leaves_the_old_version(spark):
    """Half the tasks write their part before one fails."""
    table = Versioned(spark, scratch_dir(spark, "versions"))
    table.write(spark.range(100))
    bad = spark.range(0, 1000, 1, 8).selectExpr(
        "CASE WHEN id = 999 THEN CAST(raise_error('midway') AS BIGINT) ELSE id END AS id")
    with pytest.raises(Exception, match="midway"):
        table.write(bad)
    assert table.read().count() == 100 and table.current().rows == 100
    assert len(glob.glob(f"{table.path}/versions/*")) == 1
    assert [os.path.basename(p) for p in glob.glob(f"{table.path}/current*")] == ["current"]
    table.write(spark.range(7))
    assert table.read().count() == 7


def test_a_write_that_fails_to_publish_leaves_the_old_version(spark, monkeypatch):
    table = Versioned(spark, scratch_dir(spark, "versions"))
    table.write(spark.range(5))

    def lost(*args):
        raise OSError("lost")

    monkeypatch.setattr(table.files, "replace", lost)
    with pytest.raises(OSError):
        table.write(spark.range(9))
    assert Versioned(spark, table.path).read().count() == 5


def test_job_does_not_count_the_report(spark, monkeypatch):
    """The rows of the run log come from the snapshot's write."""
    from pyspark.sql.classic.dataframe import DataFrame

    def no_count(self):
        raise AssertionError("a job counts the report")

    t = make_tables(spark, sales=[sale(), sale(partner_raw="2")], taxes=[tax()], fees=[fee()])
    monkeypatch.setattr(DataFrame, "count", no_count)
    row = run(spark, t, "invoice_summary", run_date=dt.date(2024, 5, 1),
              out=scratch_dir(spark, "job-observe"))
    assert row.first().rows_returned == 2


def test_job_writes_snapshot_export_and_log(spark):
    t = make_tables(spark, sales=[sale(), sale(partner_raw="2")], taxes=[tax()], fees=[fee()])
    out = scratch_dir(spark, "job")
    row = run(spark, t, "invoice_summary", run_date=dt.date(2024, 5, 1), out=out).first()
    assert (row.status, row.report, row.rows_returned) == ("success", "invoice_summary", 2)
    assert row.table_name == "invoice_summary_20240501"
    snap = read_snapshot(spark, f"{out}/snapshots", "invoice_summary", dt.date(2024, 5, 1))
    assert snap.count() == 2
    csv = glob.glob(f"{out}/exports/invoice_summary_20240501/part-*.csv")
    text = "".join(open(p).read() for p in sorted(csv))
    assert text.splitlines()[0].startswith("invoice_id,input_date,")
    assert "TOTAL" in text
    log = spark.read.parquet(f"{out}/run_log").collect()
    assert len(log) == 1 and log[0].exported is True
    read = read_cells(spark, f"{out}/exports/invoice_summary_20240501", snap.columns)
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, report_cells(snap).collect()))


def test_a_failed_export_is_on_record(spark, monkeypatch):
    from ledgerlens import job

    def broken(*args):
        raise OSError("disk full")

    monkeypatch.setattr(job, "export_cells", broken)
    t = make_tables(spark, sales=[sale()])
    row = run(spark, t, "invoice_summary", run_date=dt.date(2024, 5, 1),
              out=scratch_dir(spark, "job-no-export")).first()
    assert (row.status, row.exported) == ("success", False)


def test_session_settings_apply_without_a_size(spark, monkeypatch):
    from ledgerlens import job
    from ledgerlens.session import SCALE_CONF

    applied = []
    monkeypatch.setattr(job, "apply_unset", lambda s, conf: applied.append(conf))
    root = scratch_dir(spark, "bad-partner")
    make_tables(spark, sales=[sale(partner_raw="12x")]).sales.write.parquet(f"{root}/sales_lines")
    rest = make_tables(spark)
    for name in ("taxes", "fees", "accounts"):
        getattr(rest, name).write.parquet(f"{root}/{name}")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        job.main(["--tables", root, "--out", scratch_dir(spark, "bad-partner-out")])
    assert applied == [SCALE_CONF] and SCALE_CONF["spark.sql.ansi.enabled"] == "true"


def test_job_with_empty_partner_report_logs_zero_rows(spark):
    t = make_tables(spark, sales=[sale()])
    out = scratch_dir(spark, "job-empty")
    row = run(spark, t, "partner_summary", RunFilter(contract_code="nope"),
              dt.date(2024, 5, 1), out).first()
    assert row.rows_returned == 0
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, f"{out}/snapshots", "partner_summary", dt.date(2024, 5, 1))


def test_job_rejects_unknown_report(spark):
    t = make_tables(spark, sales=[sale()])
    with pytest.raises(ValueError):
        run(spark, t, "nonsense")


def test_job_command_line(spark, capsys):
    from ledgerlens.job import main

    tables = make_tables(spark, sales=[sale(), sale(partner_raw="2")], taxes=[tax()],
                         fees=[fee()])
    root = scratch_dir(spark, "cli-tables")
    tables.materialize(root)
    out = scratch_dir(spark, "cli-out")
    sized = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    saved = {k: spark.conf.get(k) for k in sized}
    try:
        main(["--report", "settlement_summary", "--tables", root, "--out", out,
              "--partner-id", "1000", "--run-date", "2024-02-03", "--sales-bytes", "1000000"])
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert "settlement_summary_20240203" in capsys.readouterr().out
    day = dt.date(2024, 2, 3)
    assert read_snapshot(spark, f"{out}/snapshots", "settlement_summary", day).count() == 2


def test_an_export_computes_its_report_once(spark):
    """The emptiness check and the write read one result."""
    computed = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def seen(x):
        computed.add(1)
        return x

    df = spark.range(0, 40, 1, 4).select(seen("id").alias("id"))
    assert export_cells(df, scratch_dir(spark, "export-once"))
    assert computed.value == 40
