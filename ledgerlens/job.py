"""The report job: compute one report, snapshot it, export it, log the run.

    python -m ledgerlens.job --report partner_summary --tables <parquet root> \
        --out <output root> [--partner-id N | --contract-code C] [--run-date YYYY-MM-DD]

The report is computed exactly once: it is checkpointed (reliably, into the
session's shared ``spark.checkpoint.dir``), which both cuts the lineage — a
lost executor does not re-run the scans — and lets the snapshot and the export
read the small result instead of recomputing it. The snapshot's write counts the
rows as they pass (an Observation): no job of its own counts them.
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.operators.filters import NO_FILTER, RunFilter
from ledgerlens.plans.invoice import invoice_summary
from ledgerlens.plans.partner import partner_summary
from ledgerlens.plans.settlement import settlement_summary
from ledgerlens.session import SCALE_CONF, apply_unset, cluster_conf, ensure_checkpoint_dir
from ledgerlens.sinks.export import export_cells
from ledgerlens.sinks.runlog import append_run_log, run_log_row
from ledgerlens.sinks.snapshot import snapshot, snapshot_name
from ledgerlens.sources.catalog import Tables

log = logging.getLogger(__name__)

REPORTS: dict[str, Callable[[Tables, RunFilter], DataFrame]] = {
    "partner_summary": partner_summary,
    "invoice_summary": invoice_summary,
    "settlement_summary": settlement_summary,
}
DEFAULT_REPORT = "partner_summary"


def run(spark: SparkSession, tables: Tables, report: str = DEFAULT_REPORT,
        run_filter: RunFilter = NO_FILTER, run_date: dt.date | None = None,
        out: str | None = None, legacy_strings: bool = False) -> DataFrame:
    """Run one report end to end and return its run-log row.

    Unknown report names raise ``ValueError`` before any work is done.
    """
    if report not in REPORTS:
        raise ValueError(f"unknown report {report!r}; expected one of {sorted(REPORTS)}")
    run_date = run_date or dt.date.today()
    ensure_checkpoint_dir(spark)
    out = (out or ensure_checkpoint_dir(spark)).rstrip("/")
    table_name = snapshot_name(report, run_date)
    try:
        result = REPORTS[report](tables, run_filter).checkpoint(eager=True)
        written = snapshot(result, f"{out}/snapshots", report, run_date)
        rows = written.rows if written else 0
        try:
            exported = export_cells(result, f"{out}/exports/{table_name}", legacy_strings, rows)
        except Exception:  # an export failure does not fail the run, but is on record
            log.exception("export of %s failed", table_name)
            exported = False
        row = run_log_row(spark, "success", report, rows, table_name, out, run_date, exported)
    except Exception:
        append_run_log(
            run_log_row(spark, "error", report, 0, table_name, out, run_date, False), out)
        raise
    append_run_log(row, out)
    return row


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--report", default=DEFAULT_REPORT, choices=sorted(REPORTS))
    p.add_argument("--tables", required=True, help="parquet root of the four input tables")
    p.add_argument("--out", required=True, help="output root (snapshots, exports, run_log)")
    p.add_argument("--partner-id")
    p.add_argument("--contract-code")
    p.add_argument("--run-date", type=dt.date.fromisoformat)
    p.add_argument("--legacy-strings", action="store_true")
    p.add_argument("--sales-bytes", type=int,
                   help="compressed size of the sales history; sizes shuffles and scans")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("ledgerlens").getOrCreate()
    # always: without them a bad partner id would become a NULL partner on a
    # cluster with ANSI off; the size only adds the sizing
    apply_unset(spark, cluster_conf(a.sales_bytes) if a.sales_bytes else SCALE_CONF)
    row = run(spark, Tables.from_parquet(spark, a.tables), a.report,
              RunFilter(a.partner_id, a.contract_code), a.run_date, a.out, a.legacy_strings)
    print(row.first().asDict())


if __name__ == "__main__":
    main()
