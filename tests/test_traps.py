"""Cases where a plausible reading gives other rows. Small frames, results written out."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

import pytest
import steps
from conftest import rows, ts
from pyspark.sql import functions as F

from asiento.operators import state
from asiento.operators.invoices import invoice_rows, post_invoices
from asiento.operators.payments import payment_rows
from asiento.operators.reversals import reversal_calls, reversal_slices, reversed_documents
from asiento.plans import posting
from asiento.slices import Slice, SliceSet, as_date
from asiento.sources.schemas import JOURNAL

DAY = "2024-01-05"


@pytest.fixture(scope="module")
def one(spark):
    return SliceSet.of(spark, [(DAY, 1, "G")])


def accounts(company, *params):
    return [
        dict(pp_id_empresa=company, pp_id_param=p, pp_cuenta=f"9{company}{p:03}") for p in params
    ]


def call(spark, company):
    return reversal_calls(spark, [("2024-02-05", company)])


LATE_MAP = dict(pp_id_empresa=1, pp_id_param=14, pp_cuenta="2141005", pp_descripcion_cta="LATE")


def journal(spark, *given):
    return spark.createDataFrame([tuple(r.get(n) for n in JOURNAL.names) for r in given], JOURNAL)


# -- NULL and zero amounts ------------------------------------------------------------


def test_invoices_drop_null_amounts_and_zeros(billing, one, ctx):
    tables = billing(
        invoice_line=[
            dict(de_numero=1, de_itbis=None),
            dict(de_numero=2, de_itbis=0.0),
            dict(de_numero=3, de_itbis=5.0),
        ]
    )
    assert rows(invoice_rows(tables, one, ctx, ["tax"]), "in_num_documento") == [(1,), (2,), (3,)]
    assert rows(post_invoices(tables, one, ctx, ["tax"]), "in_num_documento", "in_valor") == [
        (3, -5.0)
    ]


def test_payments_keep_null_amounts_but_no_zeros(billing, one, ctx):
    tables = billing(
        payment_form=[
            dict(fp_num_pago=1, fp_forma_pago="EFE", fp_valor=None),
            dict(fp_num_pago=2, fp_forma_pago="EFE", fp_valor=0.0),
            dict(fp_num_pago=3, fp_forma_pago="EFE", fp_valor=7.0),
        ]
    )
    kept = posting.post_payments(tables, one, ctx)
    assert rows(kept, "in_num_documento", "in_valor") == [(1, None), (3, 7.0)]


def test_a_null_part_makes_the_discount_null(billing, one, ctx):
    tables = billing(
        invoice_line=[dict(de_descuento_lj=4.0, de_monto_financiado=None)],
        invoice_account_map=[dict(pf_id_parametro=12)],
    )
    assert rows(invoice_rows(tables, one, ctx, ["discount"]), "in_valor") == [(None,)]


def test_decimal_sink_purges_what_rounds_to_zero(billing, one, ctx):
    tables = billing(payment_form=[dict(fp_forma_pago="EFE", fp_valor=0.004)])
    assert posting.post_payments(tables, one, ctx).count() == 1
    cents = replace(ctx, sink_decimal=(18, 2))
    assert posting.post_payments(tables, one, cents).count() == 0


def test_decimal_money_is_computed_as_double(billing, one, ctx):
    tables = billing(
        payment_form=[dict(fp_forma_pago="NC", fp_valor=100.0)],
        payment_account_map=accounts(1, 7),
    )
    exact = tables.payment_form.withColumn("fp_valor", F.col("fp_valor").cast("decimal(18,2)"))
    tables = replace(tables, payment_form=exact)
    assert rows(payment_rows(tables, one, ctx, ["credit_note"]), "in_valor") == [(100.0 / 1.18,)]


# -- second system --------------------------------------------------------------------


def test_second_system_posts_once_per_slice_as_company_1(spark, billing, ctx):
    tables = billing(
        ext_payment_form=[dict(fp_num_pago=5)], payment_account_map=accounts(1, 2, 3)
    )
    slices = SliceSet.of(spark, [(DAY, 1, "G"), (DAY, 2, "G"), (DAY, 3, "G"), (DAY, 3, "R")])
    found = payment_rows(tables, slices, ctx, ["ext_card_commission"])
    # Booked as company 1 each time, at the rate of the slice's company.
    assert rows(found, "slice_id", "in_cod_empresa", "in_valor") == [
        (1, 1, 100 * 0.04),
        (2, 1, 100 * 0.04),
        (3, 1, 100 * 0.035),
    ]
    guarded = replace(ctx, ext_only_for_company=1)
    found = payment_rows(tables, slices, guarded, ["ext_card_commission"])
    assert rows(found, "slice_id") == [(1,)]


def test_second_system_duplicates_over_companies(spark, billing, ctx):
    tables = billing(
        ext_payment_form=[dict(fp_num_pago=5)], payment_account_map=accounts(1, 2)
    )
    slices = SliceSet.of(spark, [(DAY, 1, "G"), (DAY, 2, "G")])
    final = posting.final_state(journal(spark), tables, slices, ctx)
    assert final.count() == 2
    guarded = replace(ctx, ext_only_for_company=1)
    assert posting.final_state(journal(spark), tables, slices, guarded).count() == 1


def test_zeros_of_the_second_system_survive_other_companies(spark, billing, ctx):
    tables = billing(
        ext_payment_form=[dict(fp_valor=0.0)], payment_account_map=accounts(1, 2)
    )
    for company, left in ((1, 0), (2, 1)):
        slices = SliceSet.of(spark, [(DAY, company, "G")])
        assert posting.final_state(journal(spark), tables, slices, ctx).count() == left


# -- purge of type-5 documents ----------------------------------------------------------


def test_purge_crosses_companies_and_number_spaces(spark, billing, one, ctx):
    old = journal(
        spark,
        dict(in_num_documento=7, in_tipo_documento=0, in_cod_empresa=2, in_valor=1.0),
        dict(in_num_documento=7, in_tipo_documento=6, in_cod_empresa=2, in_valor=1.0),
        dict(in_num_documento=7, in_tipo_documento=None, in_cod_empresa=2, in_valor=1.0),
        dict(in_num_documento=8, in_tipo_documento=0, in_cod_empresa=2, in_valor=1.0),
    )
    tables = billing(
        payment=[dict(p_numero=7, p_tipo_docum=5, p_cod_empresa=3, p_estado="R")],
        ext_payment_form=[dict(fp_num_pago=7), dict(fp_num_pago=9)],
        payment_account_map=accounts(1, 2),
    )
    final = posting.payments_state(old, tables, one, ctx)
    assert rows(final, "in_num_documento", "in_tipo_documento") == [
        (7, 6),
        (7, None),
        (8, 0),
        (9, 0),
    ]


def test_a_run_is_purged_by_its_own_date_only(spark, billing, ctx):
    tables = billing(
        payment=[dict(p_numero=1, p_tipo_docum=5, p_fecha=ts("2024-01-06 09:00"))],
        payment_form=[dict(fp_forma_pago="EFE", fp_num_pago=1)],
    )
    slices = SliceSet.of(spark, [("2024-01-05", 1, "G"), ("2024-01-06", 2, "G")])
    assert posting.post_payments(tables, slices, ctx).count() == 1
    # The later run purges the row of the earlier one, whatever its company.
    assert posting.final_state(journal(spark), tables, slices, ctx).count() == 0


# -- replacing slices -------------------------------------------------------------------


def test_replace_clears_every_date_and_state_of_the_company(spark, billing, one, ctx):
    old = journal(
        spark,
        dict(in_num_documento=1, in_tipo_documento=6, in_cod_empresa=1, in_estado="R"),
        dict(in_num_documento=2, in_tipo_documento=6, in_cod_empresa=2),
        dict(in_num_documento=3, in_tipo_documento=0, in_cod_empresa=1),
        dict(in_num_documento=4, in_tipo_documento=None, in_cod_empresa=1),
        dict(in_num_documento=5, in_tipo_documento=6, in_cod_empresa=None),
    )
    tables = billing()
    after = posting.invoices_state(old, tables, one, ctx)
    assert rows(after, "in_num_documento") == [(2,), (3,), (4,), (5,)]
    after = posting.payments_state(old, tables, one, ctx)
    assert rows(after, "in_num_documento") == [(1,), (2,), (4,), (5,)]
    assert rows(steps.clear_invoices(old, 1), "in_num_documento") == [(2,), (3,), (4,), (5,)]
    assert rows(steps.clear_payments(old, 1), "in_num_documento") == [(1,), (2,), (4,), (5,)]


def test_zero_purge_keeps_null_invoices_and_other_companies(spark):
    old = journal(
        spark,
        dict(in_num_documento=1, in_tipo_documento=0, in_cod_empresa=1, in_valor=0.0),
        dict(in_num_documento=2, in_tipo_documento=0, in_cod_empresa=1, in_valor=None),
        dict(in_num_documento=3, in_tipo_documento=6, in_cod_empresa=1, in_valor=0.0),
        dict(in_num_documento=4, in_tipo_documento=0, in_cod_empresa=2, in_valor=0.0),
        dict(in_num_documento=5, in_tipo_documento=None, in_cod_empresa=1, in_valor=0.0),
    )
    assert rows(steps.purge_zeros(old, 1), "in_num_documento") == [(2,), (3,), (4,), (5,)]
    assert rows(state.purge_zeros(old, F.lit(1)), "in_num_documento") == [(2,), (3,), (4,), (5,)]


def test_payment_lines_of_another_company_stay_behind(spark, billing, one, ctx):
    tables = billing(
        payment=[dict()],
        invoice=[dict()],
        payment_line=[dict(dp_cod_empresa=2)],
        payment_account_map=accounts(1, 1),
    )
    found = payment_rows(tables, one, ctx, ["receivable"])
    assert rows(found, "in_cod_empresa", "in_valor") == [(2, -100.0)]
    twice = SliceSet.of(spark, [(DAY, 1, "G"), (DAY, 1, "G")])
    assert posting.final_state(journal(spark), tables, twice, ctx).count() == 2


# -- replay -----------------------------------------------------------------------------


def test_replay_posts_company_1_whatever_was_asked(spark, billing, ctx):
    tables = billing(
        payment_reversal=[dict(rp_cod_empresa=2)],
        payment=[dict()],
        payment_form=[
            dict(fp_num_pago=11, fp_forma_pago="EFE", fp_estado="R", fp_cod_empresa=1),
            dict(fp_num_pago=12, fp_forma_pago="EFE", fp_estado="R", fp_cod_empresa=2),
        ],
    )
    other = replace(ctx, user="ME")
    replay = posting.replay_reversals(tables, call(spark, 2), other)
    assert rows(replay.journal_by_slice, "in_num_documento", "in_operador") == [(11, "SA")]
    replay = posting.replay_reversals(
        tables, call(spark, 2), ctx, replay_company="requested"
    )
    assert rows(replay.journal_by_slice, "in_num_documento") == [(12,)]


def test_replay_keeps_only_the_last_date_in_the_journal(spark, billing, ctx):
    tables = billing(
        payment_reversal=[dict(rp_num_pago=1), dict(rp_num_pago=2)],
        payment=[dict(p_numero=1), dict(p_numero=2, p_fecha=ts("2024-01-06 01:00"))],
        payment_form=[
            dict(fp_num_pago=11, fp_forma_pago="EFE", fp_estado="R"),
            dict(
                fp_num_pago=12, fp_forma_pago="EFE", fp_estado="R", fp_fecha=ts("2024-01-06 02:00")
            ),
        ],
    )
    replay = posting.replay_reversals(tables, call(spark, 1), ctx)
    assert rows(replay.journal_by_slice, "slice_id", "in_num_documento") == [(1, 11), (2, 12)]
    final = posting.final_state(journal(spark), tables, replay.slices, ctx)
    assert rows(final, "in_num_documento") == [(12,)]


def test_replay_without_documents_posts_nothing(spark, billing, ctx):
    replay = posting.replay_reversals(billing(), call(spark, 1), ctx)
    assert replay.journal_by_slice.count() == 0


def test_second_system_reversals_belong_to_company_1(spark, billing, ctx):
    tables = billing(ext_payment_reversal=[dict()], ext_payment=[dict()])
    found = reversed_documents(tables, call(spark, 1), ctx)
    assert rows(found, "num_doc", "fecha_contable", "empresa") == [(1, date(2024, 1, 5), 1)]
    assert reversed_documents(tables, call(spark, 2), ctx).count() == 0
    both = reversal_calls(spark, [("2024-02-05", 2), ("2024-02-05", 1)])
    found = reversed_documents(tables, both, ctx)
    assert rows(found, "llamada", "num_doc") == [(2, 1)]


@pytest.mark.parametrize("bad", ["2024-13-01", "yesterday", "05/02/2024"])
def test_a_bad_reversal_date_is_an_error(spark, bad):
    with pytest.raises(ValueError):
        reversal_calls(spark, [(bad, 1)])


def test_replays_of_several_calls_run_one_after_the_other(spark, billing, ctx):
    tables = billing(
        payment_reversal=[
            dict(rp_num_pago=1),
            dict(rp_num_pago=2, rp_fecha=ts("2024-02-04 10:00")),
        ],
        payment=[dict(p_numero=1), dict(p_numero=2, p_fecha=ts("2024-01-09 01:00"))],
    )
    calls = reversal_calls(spark, [("2024-02-04", 1), ("2024-02-05", 1)])
    slices = reversal_slices(reversed_documents(tables, calls, ctx))
    # The first call replays the later date: the order of the calls comes first.
    assert rows(slices.df, "slice_id", "fecha") == [
        (1, date(2024, 1, 9)),
        (10_000_001, date(2024, 1, 5)),
    ]


# -- currencies and forms ---------------------------------------------------------------


def test_foreign_card_payments_have_tax_and_commission_but_no_income(billing, one, ctx):
    tables = billing(
        payment_form=[dict(fp_moneda=2)],
        payment_account_map=accounts(1, 2, 3),
        bank_account_map=[dict()],
        ledger_account=[dict()],
    )
    assert rows(payment_rows(tables, one, ctx), "in_param", "in_valor", "in_moneda") == [
        (2, 2.0, 2),
        (3, 4.0, 2),
    ]


def test_five_percent_form_is_not_a_pattern(billing, one, ctx):
    tables = billing(
        payment_form=[dict(fp_forma_pago="R5%"), dict(fp_forma_pago="R5X", fp_num_pago=2)],
        payment_account_map=accounts(1, 13),
    )
    assert rows(payment_rows(tables, one, ctx), "in_num_documento") == [(1,)]


def test_cash_needs_no_map_but_foreign_cash_does(billing, one, ctx):
    forms = [
        dict(fp_num_pago=1, fp_forma_pago="EFE", fp_moneda=1),
        dict(fp_num_pago=2, fp_forma_pago="EFE", fp_moneda=2),
    ]
    found = payment_rows(billing(payment_form=forms), one, ctx)
    assert rows(found, "in_num_documento", "in_param", "in_cuenta", "in_descripcion_cta") == [
        (1, 0, "1111005", "CTA CTE BANCO BHD")
    ]
    tables = billing(payment_form=forms, payment_account_map=accounts(1, 12))
    found = payment_rows(tables, one, ctx, ["cash_foreign"])
    assert rows(found, "in_num_documento", "in_param", "in_cuenta", "in_valor") == [
        (2, 12, "1112002", 2.0)
    ]


# -- account maps -----------------------------------------------------------------------


def test_duplicate_map_rows_multiply_postings(billing, one, ctx):
    tables = billing(
        payment_form=[dict(fp_forma_pago="NC")], payment_account_map=accounts(1, 7, 7)
    )
    assert payment_rows(tables, one, ctx).count() == 2
    tables = billing(
        invoice_line=[dict()],
        invoice_account_map=[
            dict(pf_id_parametro=15, pf_cuenta="a"),
            dict(pf_id_parametro=15, pf_cuenta="b"),
            dict(pf_id_parametro=1, pf_cuenta="c"),
            dict(pf_id_parametro=1, pf_cuenta="c"),
        ],
    )
    found = post_invoices(tables, one, ctx)
    assert rows(found, "in_param", "in_cuenta") == [(1, "c"), (1, "c"), (15, "a"), (15, "b")]


def test_duplicate_late_accounts_multiply_deposits(billing, one, ctx):
    tables = billing(
        payment_form=[dict(fp_forma_pago="CHQ")],
        payment_account_map=[LATE_MAP, {**LATE_MAP, "pp_id_param": 99}],
        bank_account_map=[dict()],
        ledger_account=[dict()],
    )
    found = payment_rows(tables, one, ctx)
    assert rows(found, "in_param", "in_cuenta") == [(1, "1111001"), (1, "1111001")]


def test_lines_without_tax_account_still_post_their_tax(billing, one, ctx):
    mapped = [dict(pf_id_producto=10, pf_id_parametro=1), dict(pf_id_producto=20, pf_id_parametro=15)]
    tables = billing(
        invoice_line=[
            dict(de_numero=1, de_item=10),  # mapped, but not for tax
            dict(de_numero=2, de_item=20),  # mapped for tax only
            dict(de_numero=3, de_item=30),  # not mapped at all
            dict(de_numero=4, de_item=None),
        ],
        invoice_account_map=mapped,
    )
    found = post_invoices(tables, one, ctx)
    assert rows(found, "in_num_documento", "in_param", "in_valor") == [
        (1, 1, 118.0),
        (1, None, -18.0),
        (2, 15, -18.0),
        (3, None, -18.0),
        (4, None, -18.0),
    ]
    alone = invoice_rows(tables, one, ctx, ["tax"])
    assert rows(alone, "in_num_documento", "in_param") == [(1, None), (2, 15), (3, None), (4, None)]


def test_missing_map_rows_drop_postings(billing, one, ctx):
    tables = billing(
        payment_form=[dict(fp_forma_pago=f) for f in ("RTC", "RT1", "R5%", "CCA", "NC", "CRC")],
        payment_account_map=accounts(2, 7, 8, 9, 13, 15, 24),
    )
    assert payment_rows(tables, one, ctx).count() == 0


def test_deposits_need_the_late_account_even_in_time(billing, one, ctx):
    given = dict(
        payment_form=[dict(fp_forma_pago="DPC")],
        bank_account_map=[dict()],
        ledger_account=[dict()],
    )
    assert payment_rows(billing(**given), one, ctx).count() == 0
    assert payment_rows(billing(**given, payment_account_map=[LATE_MAP]), one, ctx).count() == 1


def test_bank_postings_need_ledger_account_of_the_same_unit(billing, one, ctx):
    given = dict(payment_form=[dict()], bank_account_map=[dict()])
    for unit, count in (("U1", 1), ("U2", 0), (None, 0)):
        tables = billing(**given, ledger_account=[dict(cu_uni_neg=unit)])
        assert payment_rows(tables, one, ctx).count() == count


def test_invoice_and_payment_parameters_are_separate(billing, one, ctx):
    tables = billing(
        invoice_line=[dict(de_descuento_lj=3.0)],
        invoice_account_map=[dict(pf_id_parametro=12, pf_cuenta="inv")],
        payment_form=[dict(fp_forma_pago="EFE", fp_moneda=2)],
        payment_account_map=[dict(pp_id_param=12, pp_cuenta="pay")],
    )
    assert rows(post_invoices(tables, one, ctx, ["discount"]), "in_cuenta") == [("inv",)]
    assert rows(payment_rows(tables, one, ctx), "in_cuenta") == [("1112002",)]


# -- dates ------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("form", "deposited", "late"),
    [
        ("DPC", ts("2024-01-31"), False),
        ("DPC", ts("2023-12-31"), True),
        ("DPC", ts("2023-01-05"), True),
        ("DPC", ts("2024-02-01"), True),
        ("DPC", None, False),
        ("CHQ", ts("2023-12-31"), False),
    ],
)
def test_late_deposits_compare_month_and_year(billing, one, ctx, form, deposited, late):
    tables = billing(
        payment_form=[dict(fp_forma_pago=form, fp_fecha_deposito=deposited)],
        payment_account_map=[LATE_MAP],
        bank_account_map=[dict()],
        ledger_account=[dict()],
    )
    found = payment_rows(tables, one, ctx)
    expected = (14, "2141005", "LATE") if late else (1, "1111001", "BANK")
    assert rows(found, "in_param", "in_cuenta", "in_descripcion_cta") == [expected]


def test_receivables_filter_by_document_date_but_post_the_payment_date(billing, one, ctx):
    tables = billing(
        payment=[dict(p_fecha=ts("2023-11-11 11:00"))],
        invoice=[dict(fa_fecha=ts("2023-10-10"))],
        payment_line=[dict(), dict(dp_fecha_documento=ts("2024-01-06"))],
        payment_account_map=accounts(1, 1),
    )
    found = payment_rows(tables, one, ctx, ["receivable"])
    assert rows(found, "in_fecha_cont", "in_fecha_facturaCXC") == [
        (ts("2023-11-11 11:00"), ts("2023-10-10"))
    ]


@pytest.mark.parametrize("kind", [4, 5, 6, None])
def test_receivables_leave_out_types_4_5_6_and_null(billing, one, ctx, kind):
    tables = billing(
        payment=[dict(p_tipo_docum=kind)],
        invoice=[dict()],
        payment_line=[dict()],
        payment_account_map=accounts(1, 1),
    )
    assert payment_rows(tables, one, ctx, ["receivable"]).count() == 0


def test_slice_dates_cover_the_whole_day(billing, one, ctx):
    tables = billing(
        invoice_line=[
            dict(de_numero=1, de_fecha=ts("2024-01-05 00:00")),
            dict(de_numero=2, de_fecha=ts("2024-01-05 23:59:59.999999")),
            dict(de_numero=3, de_fecha=ts("2024-01-06 00:00")),
            dict(de_numero=4, de_fecha=None),
        ]
    )
    assert rows(post_invoices(tables, one, ctx), "in_num_documento") == [(1,), (2,)]


def test_dates_of_slices_are_truncated():
    assert Slice("2024-01-05T13:00:00", 1, "G").fecha == date(2024, 1, 5)
    assert as_date(ts("2024-01-05 13:00")) == date(2024, 1, 5)


# -- text -------------------------------------------------------------------------------


def test_null_text_makes_the_line_text_null(billing, one, ctx):
    tables = billing(
        invoice_line=[dict(de_num_linea=1, de_descripcion=None), dict(de_num_linea=2)]
    )
    found = post_invoices(tables, one, ctx)
    assert rows(found, "in_linea", "in_descripcion_reg") == [(1, None), (2, "2-X")]


def test_codes_compare_as_bytes_unless_a_collation_is_set(spark, billing, ctx):
    tables = billing(
        payment_form=[dict(fp_forma_pago="efe ", fp_estado="g"), dict(fp_forma_pago="dpc", fp_estado="g")],
        payment_account_map=[LATE_MAP],
        bank_account_map=[dict(bp_uni_neg="u1 ")],
        ledger_account=[dict()],
    )
    loose = replace(ctx, collation="UTF8_LCASE_RTRIM")
    for slices in (
        SliceSet.of(spark, [(DAY, 1, "G")]),
        SliceSet.of(spark, [(DAY, 1, "G"), ("2024-01-06", 1, "G")]),
    ):
        assert payment_rows(tables, slices, ctx).count() == 0
        found = payment_rows(tables, slices, loose)
        assert rows(found, "in_cod_forma_pago", "in_cuenta") == [
            ("dpc", "1111001"),
            ("efe ", "1111005"),
        ]


def test_clock_time_is_used_without_a_run_time(billing, one, ctx):
    tables = billing(invoice_line=[dict()])
    found = post_invoices(tables, one, replace(ctx, run_ts=None))
    assert found.schema["in_fecha_ing"].dataType.simpleString() == "timestamp_ntz"
    assert found.filter(F.col("in_fecha_ing").isNotNull()).count() == 1
