"""ledgerlens — partner payment audit reports as Spark DataFrame plans.

From a large history of ticket sales lines plus small per-session tables of
tax rates and fixed fees, ledgerlens builds three audit reports (invoice,
settlement and partner summaries), the key lookups that support them, dated
overwrite snapshots, a formatted text export and a run log.

Every transform is a pure ``DataFrame -> DataFrame`` function over built-in
Spark operators; nothing is collected to the driver and no Python UDF runs.
"""

from ledgerlens.operators.filters import RunFilter
from ledgerlens.sources.catalog import Tables

__all__ = ["RunFilter", "Tables"]
