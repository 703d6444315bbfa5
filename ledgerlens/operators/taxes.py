"""Tax rates per billing session and the specific -> default -> 0 lookup.

Joins here are plain equi-joins on small, aggregated sides. No broadcast hint:
the tax table grows with the number of sessions, so AQE decides at run time
from the measured size (broadcast under the threshold, sort-merge beyond it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens import schemas as S
from ledgerlens.functions.columns import PERCENT, RATE_SUM_TYPE
from ledgerlens.session import stored


def sessions(base: DataFrame) -> DataFrame:
    """Distinct billing sessions of the (filtered) sales history."""
    return base.select("session_id").distinct()


def tax_rates(taxes: DataFrame, session_ids: DataFrame | None = None) -> DataFrame:
    """A1: (session, applies_to) -> summed rate as a fraction. Several rows for
    one key add up; all-NULL rates give NULL, which later falls through to the
    default rate.

    With ``session_ids`` only the sessions of the run are aggregated (J1): filtered
    runs pass the sessions of their stored lines, see :func:`run_sessions`. A run
    over everything passes none, as its joins drop nothing a semi-join would."""
    if session_ids is not None:
        taxes = taxes.join(session_ids, "session_id", "left_semi")
    return (
        taxes
        .groupBy("session_id", "applies_to")
        .agg((F.sum("rate_pct").cast(RATE_SUM_TYPE) * F.lit(PERCENT)).alias("tax_rate"))
    )


def run_sessions(lines: DataFrame, filtered: bool, name: str) -> tuple[DataFrame, DataFrame | None]:
    """(the run's aggregated lines, its sessions with repeats or None for all).

    A filtered run stores its lines, aggregated already, so that the sessions that
    prune the tax and fee tables come from a few rows of known size instead of a
    second pass over the history. A run over everything needs no such list."""
    if not filtered:
        return lines, None
    lines = stored(lines, name)
    return lines, lines.select("session_id")


def session_rates(rates: DataFrame) -> DataFrame:
    """session -> map of each key with its rate, the default among them: what J4 and
    J5 look up in one join. :func:`tax_rates` has one row per key, so a map holds as
    many entries as the session has taxed plans and fee descriptions."""
    return (
        rates.where("session_id IS NOT NULL AND applies_to IS NOT NULL")
        .groupBy(F.col("session_id").alias("_rates_session"))
        .agg(F.map_from_entries(F.collect_list(F.struct("applies_to", "tax_rate")))
             .alias("_rates")))


def attach_rates(df: DataFrame, rates: DataFrame, key: str) -> DataFrame:
    """Add ``tax_rate`` and ``tax_source`` by one rule: the session's rate for the SQL
    expression ``key``, else the session's default rate, else 0. A key whose summed
    rate is NULL counts as none. The rates are unique per session: no fan-out."""
    default = f"'{S.TAX_DEFAULT_KEY}'"
    steps = [(f"try_element_at(_rates, {key})", "specific"),
             (f"try_element_at(_rates, {default})", "default")]
    rate = ", ".join(e for e, _ in steps)
    source = " ".join(f"WHEN {e} IS NOT NULL THEN '{name}'" for e, name in steps)
    return (
        df.join(session_rates(rates), F.expr("session_id = _rates_session"), "left")
        .selectExpr(*[f"`{c}`" for c in df.columns],
                    f"coalesce({rate}, CAST(0 AS decimal(13,6))) AS tax_rate",
                    f"CASE {source} ELSE 'none' END AS tax_source"))
