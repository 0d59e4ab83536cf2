"""What must hold whatever the data."""

from __future__ import annotations

import pytest
import steps
from pyspark.sql import functions as F

from asiento.operators import state
from asiento.operators.invoices import post_invoices
from asiento.operators.payments import payment_rows
from asiento.plans import posting
from asiento.slices import ROW_COLUMNS, SliceSet
from catalogue import fixtures
from catalogue.queries import invoice_calendar, payment_calendar

SLICES = [
    ("2024-01-04", 2, "G"),
    ("1997-03-01", 1, "G"),
    ("2024-01-05", 1, "G"),
    ("2024-01-05", 3, "R"),
    ("1997-04-01", 3, "R"),
    ("2024-01-04", 2, "R"),
    ("2024-01-06", 1, "R"),
]


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return fixtures.tables(spark, sf_dir)


def same(left, right):
    columns = left.columns
    assert sorted(columns) == sorted(right.columns)
    right = right.select(*columns)
    assert left.exceptAll(right).count() == 0
    assert right.exceptAll(left).count() == 0


def test_card_postings_add_up_to_the_payment(spark, tables, ctx):
    slices = payment_calendar(spark)
    found = payment_rows(
        tables, slices, ctx, ["card_tax", "card_commission", "card_income"]
    ).filter(F.col("in_moneda") == 1)
    sums = found.groupBy("in_num_documento").agg(
        F.sum("in_valor").alias("total"), F.count("*").alias("n")
    )
    forms = tables.payment_form.filter("fp_forma_pago = 'TRJ' and fp_moneda = 1")
    split = sums.filter("n = 3").join(forms, F.col("in_num_documento") == F.col("fp_num_pago"))
    assert split.count() > 10
    assert split.filter(F.abs(F.col("total") - F.col("fp_valor")) > 1e-9 * F.abs("fp_valor")).isEmpty()


def test_credit_notes_add_up_to_the_payment(spark, tables, ctx):
    found = payment_rows(
        tables, payment_calendar(spark), ctx, ["credit_note", "credit_note_tax"]
    )
    sums = found.groupBy("in_num_documento").agg(F.sum("in_valor").alias("total"))
    split = sums.join(tables.payment_form, F.col("in_num_documento") == F.col("fp_num_pago"))
    assert split.count() > 10
    assert split.filter(F.abs(F.col("total") - F.col("fp_valor")) > 1e-9 * F.abs("fp_valor")).isEmpty()


def test_many_slices_post_what_single_slices_post(spark, tables, ctx):
    together = SliceSet.of(spark, SLICES)
    for post in (post_invoices, posting.post_payments):
        alone = None
        for one in SLICES:
            part = post(tables, SliceSet.of(spark, [one]), ctx).drop(*ROW_COLUMNS)
            alone = part if alone is None else alone.unionByName(part)
        same(post(tables, together, ctx).drop(*ROW_COLUMNS), alone)


@pytest.mark.parametrize("order", [SLICES, SLICES[::-1], SLICES[3:]], ids=["a", "b", "c"])
def test_final_state_equals_one_run_after_the_other(spark, sf_dir, tables, ctx, order):
    """The set-wise state against the plain steps of each run, in order."""
    journal = fixtures.initial_journal(spark, sf_dir)
    step = journal
    for one in order:
        slices, company = SliceSet.of(spark, [one]), one[1]
        step = state.append_rows(
            steps.clear_invoices(step, company), post_invoices(tables, slices, ctx)
        )
        step = state.append_rows(
            steps.clear_payments(step, company), payment_rows(tables, slices, ctx)
        )
        step = steps.purge_documents(step, state.purged_payments(tables.payment, slices))
        step = steps.purge_zeros(step, company).checkpoint()
    listed = SliceSet.of(spark, order)
    same(posting.final_state(journal, tables, listed, ctx), step)
    same(posting.final_state(journal, tables, SliceSet.from_frame(listed.df), ctx), step)


def test_invoice_runs_are_idempotent(spark, sf_dir, tables, ctx):
    journal = fixtures.initial_journal(spark, sf_dir)
    slices = SliceSet.of(spark, [("1997-03-01", 1, "G")])
    once = posting.invoices_state(journal, tables, slices, ctx)
    same(once, posting.invoices_state(once, tables, slices, ctx))


def test_present_slices_are_the_calendar_slices_with_rows(spark, tables, ctx):
    found = SliceSet.present((tables.invoice_line, "de_fecha", "de_cod_empresa", "de_estado"))
    assert found.df.count() == found.df.select("slice_id").distinct().count()
    same(
        post_invoices(tables, found, ctx).drop(*ROW_COLUMNS),
        post_invoices(tables, invoice_calendar(spark), ctx).drop(*ROW_COLUMNS),
    )


def test_only_lasting_slices_are_posted(spark):
    listed = SliceSet.of(spark, SLICES)
    stored = SliceSet.from_frame(listed.df)
    for slices in (listed, stored):
        last = slices.last_of_companies().df.select("slice_id", "empresa", "estado").collect()
        assert sorted(map(tuple, last)) == [(5, 3, "R"), (6, 2, "R"), (7, 1, "R")]
        for company, first in ((1, 7), (2, 6), (3, 5), (4, 1)):
            numbers = slices.since_last_of(company).df.select("slice_id").collect()
            assert sorted(n for (n,) in numbers) == list(range(first, 8))
    assert listed.last_of_companies().days == stored.last_of_companies().days
