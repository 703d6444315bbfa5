"""TOTAL row + detail rows, ordered the way the reports present them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ledgerlens.session import stored

TOTAL_LABEL = "TOTAL"


def with_total(detail: DataFrame, label_col: str, measures: list[str]) -> DataFrame:
    """Prepend a TOTAL row (label in ``label_col``, NULL in every other
    non-measure column, SUM of each measure) and order by input date, newest
    first with NULL dates first; TOTAL always leads. The other non-measure columns
    break ties, so the range sort can split the rows of one input date.

    The detail is stored first: TOTAL and detail both read it, so each join of the
    report runs once (A13), and the sort's sampling pass reads it instead of
    computing it again. The TOTAL is a global aggregate, so it returns one row even for an empty
    detail (all sums NULL) — unlike a rollup, which returns none.
    """
    detail = stored(detail, "report-detail")
    fields = detail.schema.fields
    types = {f.name: f.dataType.simpleString() for f in fields}
    sums = detail.agg(*[
        F.expr(f"CAST(sum(`{m}`) AS {types[m]}) AS `{m}`")
        if isinstance(detail.schema[m].dataType, DecimalType) else F.expr(f"sum(`{m}`) AS `{m}`")
        for m in measures])
    total = sums.selectExpr(*[
        (f"'{TOTAL_LABEL}' AS `{f.name}`" if f.name == label_col
         else f"`{f.name}`" if f.name in measures
         else f"CAST(NULL AS {types[f.name]}) AS `{f.name}`")
        for f in fields], "1 AS _is_total")
    both = total.unionByName(detail.selectExpr("*", "0 AS _is_total"))
    ties = [f.name for f in fields if f.name not in (*measures, "input_date")]
    return both.orderBy(F.col("_is_total").desc(), F.col("input_date").desc_nulls_first(),
                        *ties).drop("_is_total")
