"""Run filters (optional pre-filter of the sales history by partner or contract).

Filters are typed Column predicates, never SQL text. A partner filter wins over
a contract filter; an empty, numeric-zero or missing value means "no filter".
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import partner_id as partner_id_expr


@dataclass(frozen=True)
class RunFilter:
    partner_id: int | str | None = None
    contract_code: str | None = None

    @property
    def kind(self) -> str:
        # A value is "given" when it is truthy, as in the source system: None, ""
        # and the number 0 mean no filter, while the text "0" is partner 0.
        if self.partner_id:
            return "partner"
        if self.contract_code:
            return "contract"
        return "none"

    def predicate(self, sales: DataFrame) -> Column | None:
        if self.kind == "partner":
            # int() rejects anything but an integer literal, as the typed
            # parameter of the source system did.
            value = F.lit(int(self.partner_id)).cast("long")
            if "partner_id" in sales.columns:  # stored at ingest: reaches Parquet stats
                return F.col("partner_id") == value
            return partner_id_expr() == value
        if self.kind == "contract":
            return F.col("contract_code") == F.lit(str(self.contract_code))
        return None

    def apply(self, sales: DataFrame) -> DataFrame:
        pred = self.predicate(sales)
        return sales if pred is None else sales.where(pred)


NO_FILTER = RunFilter()
