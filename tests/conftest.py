from __future__ import annotations

import datetime as dt
import itertools
import os
import sys
from decimal import Decimal as D

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerlens.session import local_session

    s = local_session(8, shuffle_partitions=8, app="ledgerlens-tests")
    yield s
    s.stop()


_item_ids = itertools.count(1_000_000)


def sale(**kw) -> dict:
    """One sales line with sensible defaults (override any column)."""
    row = dict(
        session_id=1, partner_raw="1,000", contract_code="C1", invoice_id=10,
        period_from=dt.date(2024, 1, 1), period_to=dt.date(2024, 3, 31),
        input_date=dt.date(2024, 4, 5), invoice_link="inv/10", settlement_link="set/10",
        item_id=next(_item_ids), item_status="validated/expired", plan_id=0,
        gross_amount=D("100.00"), collected_amount=D("90.0000"), commission=D("10.0000"),
        cancel_fee=D("1.0000"), commission_w_tax=D("12.100000"),
    )
    row.update(kw)
    return row


def tax(session_id=1, applies_to="default", rate_pct="10") -> dict:
    return dict(session_id=session_id, applies_to=applies_to,
                rate_pct=None if rate_pct is None else D(rate_pct))


def fee(**kw) -> dict:
    row = dict(session_id=1, contract_code="C1", fee_type="Marketing",
               fee_description="Marketing", fee_invoice=D("50.0000"),
               fee_settlement=D("100.0000"), apply_tax=True)
    row.update(kw)
    return row


def make_tables(spark, sales=(), taxes=(), fees=(), accounts=()):
    from ledgerlens import schemas as S
    from ledgerlens.sources.catalog import Tables

    def df(rows, schema):
        names = schema.fieldNames()
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)

    return Tables(df(sales, S.SALES_LINES), df(taxes, S.TAXES), df(fees, S.FEES),
                  df(accounts, S.ACCOUNTS))


def rows_by(df, key: str) -> dict:
    return {r[key]: r.asDict() for r in df.collect()}
