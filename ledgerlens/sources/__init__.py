"""Input tables: derivation from the driver data, parquet and catalog readers."""

from ledgerlens.sources.catalog import TABLE_NAMES, Tables

__all__ = ["TABLE_NAMES", "Tables"]
