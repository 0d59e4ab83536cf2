"""Random small tables, full of NULLs, duplicates and collisions, against the SQL statements."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import duckdb
import pytest
from conftest import DEFAULTS

import check
from asiento.operators import reversals
from asiento.operators.invoices import post_invoices
from asiento.operators.payments import payment_rows
from asiento.plans import posting
from asiento.slices import SliceSet
from asiento.sources.schemas import JOURNAL
from catalogue import oracle

FORMS = ("TRJ", "DPC", "CHQ", "EFE", "NC", "CRC", "RTC", "RT1", "R5%", "CCA", "XXX")
PARAMS = (0, 1, 2, 3, 7, 8, 9, 10, 11, 12, 13, 14, 15, 24)
DAYS = ("2024-01-05", "2024-01-06", "2024-02-01")
# Values of a column by its name's ending; the first match counts.
VALUES = (
    ("fecha_deposito", lambda r: datetime(r.choice((2023, 2024)), r.choice((1, 2)), 5)),
    ("forma_pago", lambda r: r.choice(FORMS)),
    ("estado", lambda r: r.choice("GR")),
    ("empresa", lambda r: r.choice((1, 2, 3))),
    ("parametro", lambda r: r.choice(PARAMS)),
    ("param", lambda r: r.choice(PARAMS)),
    ("tipo_docum", lambda r: r.choice((0, 1, 2, 4, 5, 6))),
    ("tipo_documento", lambda r: r.choice((0, 4, 5, 6))),
    ("moneda", lambda r: r.choice((1, 2))),
    ("pp_cuenta", lambda r: r.choice(("2141005", "9000001"))),
    ("cuenta_contable", lambda r: r.choice("AB")),
    ("cu_cuenta", lambda r: r.choice("AB")),
    ("uni_neg", lambda r: r.choice("UV")),
    ("descuento_sa", lambda r: r.choice((0.0, 0.0, 5.5))),
)


def day(r):
    return datetime.fromisoformat(r.choice(DAYS)) + timedelta(hours=r.randrange(24))


def value(r: random.Random, column: str, kind: str):
    if r.random() < 0.08:
        return None
    for ending, make in VALUES:
        if column.endswith(ending):
            return make(r)
    if kind == "timestamp_ntz":
        return day(r)
    if kind in ("int", "bigint"):
        return r.randrange(1, 6)
    return r.choice((0.0, 1.0, 12.34, 99.99)) if kind == "double" else r.choice("xyz")


def random_rows(r, schema, count):
    return [
        tuple(value(r, f.name, f.dataType.simpleString()) for f in schema) for _ in range(count)
    ]


@pytest.fixture(scope="module", params=range(4))
def case(request, spark, billing):
    r = random.Random(request.param)
    tables = billing()
    frames = {}
    for name in DEFAULTS:
        schema = getattr(tables, name).schema
        count = 12 if name.endswith("map") or name == "ledger_account" else 60
        if name == "payment_account_map":
            count = 45
        frames[name] = spark.createDataFrame(random_rows(r, schema, count), schema)
    journal = spark.createDataFrame(random_rows(r, JOURNAL, 60), JOURNAL)
    con = duckdb.connect()
    for name, df in (*frames.items(), ("initial_journal", journal)):
        held = df.toArrow()
        con.register("held", held)
        con.execute(f"CREATE TABLE {name} AS FROM held")
    slices = [(r.choice(DAYS), r.choice((1, 2, 3)), r.choice("GR")) for _ in range(6)]
    return type(tables)(**frames), journal, con, slices


def listed(slices):
    return " UNION ALL ".join(
        f"SELECT {n}::BIGINT AS slice_id, DATE '{d}' AS fecha, {c} AS empresa, '{s}' AS estado"
        for n, (d, c, s) in enumerate(slices, start=1)
    )


def agree(df, con, body, slices, extra=None):
    wanted = con.execute(oracle.statement(body, listed(slices), extra, tables={})).df()
    found = df.toPandas()
    assert sorted(found.columns) == sorted(wanted.columns)
    left, right = check.canonical(found), check.canonical(wanted)
    assert left.equals(right), (len(found), len(wanted))


@pytest.mark.parametrize("many", [True, False], ids=["many", "one"])
def test_postings(spark, case, ctx, many):
    tables, _, con, slices = case
    slices = slices if many else slices[:1]
    given = SliceSet.of(spark, slices)
    agree(post_invoices(tables, given, ctx), con, "SELECT * FROM posted_invoice", slices)
    agree(payment_rows(tables, given, ctx), con, "SELECT * FROM payment_row", slices)
    agree(posting.post_payments(tables, given, ctx), con, "SELECT * FROM posted_payment", slices)


@pytest.mark.parametrize("kind", ["listed", "stored"])
def test_final_state(spark, case, ctx, kind):
    tables, journal, con, slices = case
    given = SliceSet.of(spark, slices)
    if kind == "stored":
        given = SliceSet.from_frame(given.df)
    before = "(SELECT * EXCLUDE (slice_id) FROM invoice_state)"
    state = {"payment_state": oracle.ROWS["payment_state"].format(before=before)}
    agree(
        posting.final_state(journal, tables, given, ctx),
        con,
        "SELECT * EXCLUDE (slice_id, slice_empresa) FROM payment_state",
        slices,
        state,
    )


def test_reversals(spark, case, ctx):
    tables, _, con, slices = case
    calls = [(d, c, "R") for d, c, _ in slices]
    given = reversals.reversal_calls(spark, [(d, c) for d, c, _ in slices])
    documents = reversals.reversed_documents(tables, given, ctx)
    agree(documents, con, "SELECT * FROM reversed_document", calls)
    agree(reversals.reversal_dates(documents), con, "SELECT * FROM reversal_date", calls)
    replay = posting.replay_reversals(tables, given, ctx)
    body = """SELECT * FROM
        (SELECT * FROM posted_invoice UNION ALL BY NAME SELECT * FROM posted_payment)"""
    found = replay.journal_by_slice.toPandas()
    extra = oracle.calls(listed(calls))
    wanted = con.execute(oracle.statement(body, oracle.REPLAY, extra, tables={})).df()
    assert check.canonical(found).equals(check.canonical(wanted))
