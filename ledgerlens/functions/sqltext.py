"""The formula helpers of :mod:`ledgerlens.functions.columns` as SQL text.

Each ``F.*`` call from Python is a handful of JVM round trips, while one
``F.expr`` of any size is parsed in a single call. Plans that assemble dozens of
formulas build them as text with these helpers; the expressions are the same
ones (same casts, same NULL handling), only cheaper to construct.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens import schemas as S
from ledgerlens.functions.columns import FORMULA


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _status(s: str) -> str:
    return f"item_status = {lit(s)}"


# the commission the platform keeps on a line: its own, or a canceled line's fee
IS_COMMISSION_LINE = (f"item_status IN ({lit(S.STATUS_VALIDATED)}, "
                      f"{lit(S.STATUS_CANCELED)})")
TICKET_COMMISSION = (f"CASE WHEN {_status(S.STATUS_VALIDATED)} THEN commission "
                     f"WHEN {_status(S.STATUS_CANCELED)} THEN cancel_fee ELSE 0 END")


def zero_if_null(e: str) -> str:
    return f"coalesce({e}, 0)"


def add(*exprs: str) -> str:
    """a + b + … narrowed to ``FORMULA`` after every step (exact decimal)."""
    out = f"CAST({exprs[0]} AS {FORMULA})"
    for e in exprs[1:]:
        out = f"CAST({out} + {e} AS {FORMULA})"
    return out


def sub(a: str, b: str) -> str:
    return f"CAST(CAST({a} AS {FORMULA}) - {b} AS {FORMULA})"


def sum_as(e: str, type_: str) -> str:
    return f"CAST(sum({e}) AS {type_})"


def col(sql: str, alias: str) -> Column:
    return F.expr(f"{sql} AS `{alias}`")
