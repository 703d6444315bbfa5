"""Sinks: dated snapshots, the formatted text export and the run log."""

from ledgerlens.sinks.export import export_cells
from ledgerlens.sinks.runlog import append_run_log, run_log_row
from ledgerlens.sinks.snapshot import read_snapshot, snapshot, snapshot_name
from ledgerlens.sinks.versions import Versioned

__all__ = ["Versioned", "append_run_log", "export_cells", "read_snapshot", "run_log_row",
           "snapshot", "snapshot_name"]
