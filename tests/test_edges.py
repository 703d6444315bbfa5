"""Hand-made edge rows (FIXTURES.md §4): each semantic rule of the reports."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest

from conftest import fee, make_tables, rows_by, sale, tax

from ledgerlens.operators.fees import fee_detail
from ledgerlens.operators.filters import RunFilter
from ledgerlens.operators.items import item_history
from ledgerlens.operators.taxes import sessions, tax_rates
from ledgerlens.plans.invoice import invoice_summary
from ledgerlens.plans.partner import partner_summary
from ledgerlens.plans.settlement import settlement_summary


def test_purchased_only_session_is_settled_but_not_invoiced(spark):
    t = make_tables(spark, sales=[
        sale(session_id=1, invoice_id=10, settlement_link="set/10"),
        sale(session_id=2, invoice_id=20, invoice_link="inv/20", settlement_link="set/20",
             item_status="purchased"),
    ], fees=[fee(session_id=2)])
    inv = rows_by(invoice_summary(t), "invoice_id")
    assert set(inv) == {"TOTAL", "10"}
    sett = rows_by(settlement_summary(t), "settlement_link")
    assert set(sett) == {"TOTAL", "set/10", "set/20"}
    assert sett["set/20"]["marketing_fees_w_tax"] == D("100")
    assert sett["set/20"]["advance_commission_w_tax"] == D("12.1")


def test_two_partners_in_a_session_each_get_twice_the_fee(spark):
    t = make_tables(spark, sales=[sale(partner_raw="1,000"), sale(partner_raw="1,001")],
                    taxes=[tax(rate_pct="10")], fees=[fee()])
    rows = rows_by(partner_summary(t), "partner_id")
    r = rows[1000]
    assert r["marketing_fees"] == D("100")                    # 2 x invoice fee 50
    assert r["total_taxes"] == D("21")                        # 10*0.1 + 2 x 100*0.1
    assert r["partner_payment"] == D("90") - 10 - 200 - 21    # settlement fee 2 x 100
    assert rows[1001] == {**r, "partner_id": 1001}


def test_session_fee_repeats_on_each_invoice_and_in_total(spark):
    t = make_tables(spark, sales=[sale(invoice_id=10), sale(invoice_id=11, invoice_link="inv/11")],
                    fees=[fee(apply_tax=False)])
    rows = rows_by(invoice_summary(t), "invoice_id")
    assert rows["10"]["fixed_fees"] == rows["11"]["fixed_fees"] == D("50")
    assert rows["TOTAL"]["fixed_fees"] == D("100")
    assert rows["TOTAL"]["total_share"] == D("120")


def test_partner_spellings_are_normalized(spark):
    t = make_tables(spark, sales=[sale(partner_raw="1,234"), sale(partner_raw="1234")])
    rows = partner_summary(t).collect()
    assert [r.partner_id for r in rows] == [1234]
    assert rows[0].gross_collected == D("180")


def test_null_partner_gets_a_row_of_zeros(spark):
    t = make_tables(spark, sales=[sale(partner_raw=None), sale(partner_raw="7")],
                    taxes=[tax()], fees=[fee()])
    rows = partner_summary(t).collect()
    assert [r.partner_id for r in rows] == [None, 7]          # NULL first
    null = rows[0].asDict()
    assert all(v == 0 for k, v in null.items() if k != "partner_id")


def test_non_numeric_partner_fails_the_run(spark):
    t = make_tables(spark, sales=[sale(partner_raw="ACME")])
    with pytest.raises(Exception):
        partner_summary(t).collect()


def test_apply_tax_rules_differ_per_report(spark):
    sales, fees_, taxes_ = [], [], []
    for sid, flag in ((1, True), (2, False), (3, None)):
        sales.append(sale(session_id=sid, partner_raw=str(sid), invoice_id=sid * 10,
                          invoice_link=f"inv/{sid}", settlement_link=f"set/{sid}"))
        fees_.append(fee(session_id=sid, fee_type="Other", fee_description="Other",
                         apply_tax=flag))
        taxes_.append(tax(session_id=sid, rate_pct="10"))
    t = make_tables(spark, sales=sales, taxes=taxes_, fees=fees_)
    inv = rows_by(invoice_summary(t), "invoice_id")          # taxed unless FALSE
    assert (inv["10"]["taxes"], inv["20"]["taxes"], inv["30"]["taxes"]) == (6, 1, 6)
    par = rows_by(partner_summary(t), "partner_id")          # taxed only when TRUE
    assert (par[1]["total_taxes"], par[2]["total_taxes"], par[3]["total_taxes"]) == (11, 1, 1)
    sett = rows_by(settlement_summary(t), "settlement_link")  # taxed unless FALSE
    assert [sett[f"set/{i}"]["other_fees_w_tax"] for i in (1, 2, 3)] == [110, 100, 110]


def test_marketing_fee_is_taxed_in_settlement_even_when_apply_tax_is_false(spark):
    t = make_tables(spark, sales=[sale()], taxes=[tax()], fees=[fee(apply_tax=False)])
    sett = rows_by(settlement_summary(t), "settlement_link")
    assert sett["set/10"]["marketing_fees_w_tax"] == D("110")
    par = rows_by(partner_summary(t), "partner_id")
    assert par[1000]["total_taxes"] == D("1")                 # commission tax only


def test_fee_without_description(spark):
    t = make_tables(spark, sales=[sale()], taxes=[tax(rate_pct="10")],
                    fees=[fee(fee_description=None)])
    sett = rows_by(settlement_summary(t), "settlement_link")["set/10"]
    assert (sett["marketing_fees_w_tax"], sett["cash_advance_w_tax"],
            sett["other_fees_w_tax"]) == (0, 0, 0)
    detail = fee_detail(t.fees, sessions(t.sales), tax_rates(t.taxes, sessions(t.sales)))
    r = detail.collect()[0]
    assert (r.tax_rate, r.tax_source, r.fee_invoice_tax) == (D("0.1"), "default", D("5"))


def test_unknown_fee_type_is_not_in_the_partner_summary(spark):
    t = make_tables(spark, sales=[sale()], taxes=[tax()], fees=[fee(fee_type="Mystery")])
    r = rows_by(partner_summary(t), "partner_id")[1000]
    assert r["partner_payment"] == D("90") - 10 - 1
    assert r["marketing_fees"] == 0


def test_tax_rate_sources_and_fallbacks(spark):
    t = make_tables(
        spark,
        sales=[sale(session_id=s) for s in (1, 2, 3, 4, 5)],
        taxes=[tax(1, "Marketing", "5"), tax(1, "default", "10"), tax(2, "default", "10"),
               tax(4, "Marketing", None), tax(4, "default", "10"),
               tax(5, "default", "10"), tax(5, "default", "2")],
        fees=[fee(session_id=s) for s in (1, 2, 3, 4, 5)])
    ids = sessions(t.sales)
    rows = rows_by(fee_detail(t.fees, ids, tax_rates(t.taxes, ids)), "session_id")
    assert (rows[1]["tax_source"], rows[1]["tax_rate"]) == ("specific", D("0.05"))
    assert (rows[2]["tax_source"], rows[2]["tax_rate"]) == ("default", D("0.1"))
    assert (rows[3]["tax_source"], rows[3]["tax_rate"]) == ("none", D("0"))
    assert (rows[4]["tax_source"], rows[4]["tax_rate"]) == ("default", D("0.1"))  # all-NULL
    assert rows[5]["tax_rate"] == D("0.12")                                       # summed


def test_cancellation_reverses_the_item_history(spark):
    t = make_tables(spark, sales=[
        sale(item_id=5, gross_amount=D("100"), collected_amount=D("90")),
        sale(item_id=5, item_status="canceled", gross_amount=D("80"), collected_amount=D("70")),
    ])
    h = rows_by(item_history(t.sales), "item_id")[5]
    assert (h["hist_gross"], h["hist_collected"]) == (D("-100"), D("-90"))
    sett = rows_by(settlement_summary(t), "settlement_link")["set/10"]
    assert (sett["gross_revenue"], sett["collected_revenue"]) == (0, 0)
    assert rows_by(partner_summary(t), "partner_id")[1000]["gross_collected"] == 0


def test_reversal_uses_the_filtered_history_only(spark):
    t = make_tables(spark, sales=[
        sale(item_id=5, contract_code="C1", gross_amount=D("100")),
        sale(item_id=5, contract_code="C2", item_status="canceled", gross_amount=D("50")),
    ])
    full = rows_by(settlement_summary(t), "settlement_link")["set/10"]
    assert full["gross_revenue"] == 0                          # 100 - max(100, 50)
    only_c2 = rows_by(settlement_summary(t, RunFilter(contract_code="C2")), "settlement_link")
    assert only_c2["set/10"]["gross_revenue"] == D("-50")


def test_duplicate_item_status_lines_count_twice(spark):
    t = make_tables(spark, sales=[sale(item_id=7), sale(item_id=7)])
    r = rows_by(settlement_summary(t), "settlement_link")["set/10"]
    assert r["gross_revenue"] == 2 * D("200")
    assert r["collected_revenue"] == 2 * D("180")
    assert r["executed_commission_w_tax"] == 2 * D("24.2")


def test_null_item_or_status_counts_once_without_consolidated_amount(spark):
    t = make_tables(spark, sales=[
        sale(item_id=None, invoice_id=10, settlement_link="set/10"),
        sale(item_id=None, invoice_id=10, settlement_link="set/10"),
        sale(item_id=8, item_status=None, invoice_id=20, settlement_link="set/20"),
    ])
    rows = rows_by(settlement_summary(t), "settlement_link")
    assert rows["set/10"]["executed_commission_w_tax"] == D("24.2")
    assert rows["set/10"]["gross_revenue"] is None
    assert rows["set/10"]["partner_settlement"] is None
    assert rows["set/20"]["executed_commission_w_tax"] == 0
    assert rows["set/20"]["gross_revenue"] is None


def test_filter_matching_nothing(spark):
    t = make_tables(spark, sales=[sale()], fees=[fee()])
    nothing = RunFilter(contract_code="nope")
    inv = invoice_summary(t, nothing).collect()
    assert len(inv) == 1 and inv[0].invoice_id == "TOTAL" and inv[0].commission is None
    sett = settlement_summary(t, nothing).collect()
    assert len(sett) == 1 and sett[0].settlement_link == "TOTAL"
    assert partner_summary(t, nothing).count() == 0


def test_partner_filter_wins_over_contract(spark):
    f = RunFilter(partner_id=1000, contract_code="C2")
    assert f.kind == "partner"
    assert RunFilter(partner_id=0, contract_code="C2").kind == "contract"
    assert RunFilter(partner_id="0").kind == "partner"      # request text "0" is partner 0
    assert RunFilter(partner_id="", contract_code="").kind == "none"
    assert RunFilter().kind == "none"
    t = make_tables(spark, sales=[sale(contract_code="C1"), sale(partner_raw="9", contract_code="C2")])
    rows = partner_summary(t, f).collect()
    assert [r.partner_id for r in rows] == [1000]


def test_null_input_date_rows_follow_total(spark):
    t = make_tables(spark, sales=[
        sale(invoice_id=10, input_date=dt.date(2024, 1, 1)),
        sale(invoice_id=11, input_date=None, invoice_link="inv/11"),
        sale(invoice_id=12, input_date=dt.date(2024, 6, 1), invoice_link="inv/12"),
    ])
    assert [r.invoice_id for r in invoice_summary(t).collect()] == ["TOTAL", "11", "12", "10"]


def test_total_equals_sum_of_detail(spark):
    t = make_tables(spark, sales=[sale(session_id=s, invoice_id=s) for s in range(1, 6)],
                    taxes=[tax(s) for s in range(1, 6)], fees=[fee(session_id=2)])
    rows = invoice_summary(t).collect()
    total, detail = rows[0], rows[1:]
    for m in ("commission", "fixed_fees", "total_share", "taxes"):
        assert total[m] == sum(r[m] for r in detail)


def test_unknown_status_lines_self_join_within_their_status(spark):
    t = make_tables(spark, sales=[
        sale(item_id=9, item_status="refunded", commission_w_tax=D("1")),
        sale(item_id=9, item_status="refunded", commission_w_tax=D("1")),
        sale(item_id=9, item_status="canceled", gross_amount=D("30")),
    ])
    r = rows_by(settlement_summary(t), "settlement_link")["set/10"]
    # refunded pair: 2 x (100 + 100); canceled line: -max(100, 100, 30)
    assert r["gross_revenue"] == D("400") - 100
    assert r["executed_commission_w_tax"] == 0
    assert r["cancelled_commission_w_tax"] == D("12.1")
