"""Every operator as a named query, next to its check statement.

Branches run over the whole calendar of their tables: every month of invoice lines and
every day of payments, for three companies and both states. ``*_one_slice`` repeats a
posting for a single date, company and state, as one procedure call does.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asiento.context import RunContext
from asiento.operators import reversals, seeds, state
from asiento.operators.invoices import invoice_rows, post_invoices
from asiento.operators.payments import payment_rows
from asiento.plans import posting
from asiento.plans.rules import INVOICE_BRANCHES, PAYMENT_BRANCHES
from asiento.slices import ROW_COLUMNS, SliceSet
from asiento.sources.journal import JournalTable
from asiento.sources.shared import new_path
from catalogue import fixtures, oracle

Query = Callable[[SparkSession, str], DataFrame]

CTX = RunContext(user="SA", terminal="T", run_ts=fixtures.RUN_TS)
INVOICE_SLICE = ("1997-03-01", 1, "G")
PAYMENT_SLICE = ("2024-01-05", 1, "G")
REVERSAL_DATE = "2024-02-05"

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def invoice_calendar(spark: SparkSession) -> SliceSet:
    return SliceSet.calendar(
        spark, fixtures.INVOICE_MONTHS, fixtures.COMPANIES, fixtures.STATES
    )


def payment_calendar(spark: SparkSession) -> SliceSet:
    return SliceSet.calendar(spark, fixtures.PAYMENT_DAYS, fixtures.COMPANIES, fixtures.STATES)


def register(name: str, sql: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        ORACLE[name] = sql
        return query

    return add


# -- invoices -----------------------------------------------------------------------


def _invoice_branch(branch: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = fixtures.tables(spark, sf_dir, fixtures.INVOICE_TABLES)
        return invoice_rows(tables, invoice_calendar(spark), CTX, [branch]).drop(*ROW_COLUMNS)

    return query


for number, name in enumerate(INVOICE_BRANCHES, start=1):
    register(
        f"inv_{number}_{name}",
        oracle.branch(oracle.INVOICE_BRANCHES[name], oracle.INVOICE_MONTHS),
    )(_invoice_branch(name))


@register("inv_9_post", oracle.branch("SELECT * FROM posted_invoice", oracle.INVOICE_MONTHS))
def inv_9_post(spark, sf_dir):
    tables = fixtures.tables(spark, sf_dir, fixtures.INVOICE_TABLES)
    return post_invoices(tables, invoice_calendar(spark), CTX).drop(*ROW_COLUMNS)


@register(
    "inv_9_post_one_slice",
    oracle.branch("SELECT * FROM posted_invoice", oracle.one_slice(*INVOICE_SLICE)),
)
def inv_9_post_one_slice(spark, sf_dir):
    tables = fixtures.tables(spark, sf_dir, fixtures.INVOICE_TABLES)
    return post_invoices(tables, SliceSet.of(spark, [INVOICE_SLICE]), CTX).drop(*ROW_COLUMNS)


@register("inv_9_post_one_slice_keys_first", ORACLE["inv_9_post_one_slice"])
def inv_9_post_one_slice_keys_first(spark, sf_dir):
    """The same, with the work orders reduced to those of the slice before they are shuffled."""
    tables = fixtures.tables(spark, sf_dir, fixtures.INVOICE_TABLES)
    ctx = replace(CTX, keys_first=True)
    return post_invoices(tables, SliceSet.of(spark, [INVOICE_SLICE]), ctx).drop(*ROW_COLUMNS)


@register(
    "inv_post_all_months",
    oracle.statement(
        "SELECT * EXCLUDE (slice_fecha, slice_empresa) FROM posted_invoice",
        oracle.INVOICES_PRESENT,
    ),
)
def inv_post_all_months(spark, sf_dir):
    """Every slice that occurs in the invoice lines, tagged with its number."""
    tables = fixtures.tables(spark, sf_dir, fixtures.INVOICE_TABLES)
    slices = SliceSet.present((tables.invoice_line, "de_fecha", "de_cod_empresa", "de_estado"))
    return post_invoices(tables, slices, CTX).drop("slice_fecha", "slice_empresa")


# -- payments -----------------------------------------------------------------------


def _payment_branch(branch: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = fixtures.tables(spark, sf_dir, fixtures.PAYMENT_TABLES)
        return payment_rows(tables, payment_calendar(spark), CTX, [branch]).drop(*ROW_COLUMNS)

    return query


# The order in which the postings are numbered.
PAYMENT_ORDER = (
    "receivable", "card_tax", "card_commission", "card_income", "deposit", "cash_local",
    "cash_foreign", "credit_note", "credit_note_tax", "advance_received", "advance_applied",
    "withholding_30", "withholding_100", "withholding_5", "write_off", "ext_deposit",
    "ext_card_tax", "ext_card_commission", "ext_card_income",
)
assert set(PAYMENT_ORDER) == set(PAYMENT_BRANCHES)

for number, name in enumerate(PAYMENT_ORDER, start=1):
    register(
        f"pay_{number:02d}_{name}",
        oracle.branch(oracle.PAYMENT_BRANCHES[name], oracle.PAYMENT_DAYS),
    )(_payment_branch(name))


@register("pay_20_rows", oracle.branch("SELECT * FROM payment_row", oracle.PAYMENT_DAYS))
def pay_20_rows(spark, sf_dir):
    """All branches, before the purges."""
    tables = fixtures.tables(spark, sf_dir, fixtures.PAYMENT_TABLES)
    return payment_rows(tables, payment_calendar(spark), CTX).drop(*ROW_COLUMNS)


@register("pay_20_post", oracle.branch("SELECT * FROM posted_payment", oracle.PAYMENT_DAYS))
def pay_20_post(spark, sf_dir):
    """All branches, less what each run purges of its own rows."""
    tables = fixtures.tables(spark, sf_dir, fixtures.PAYMENT_TABLES)
    return posting.post_payments(tables, payment_calendar(spark), CTX).drop(*ROW_COLUMNS)


@register(
    "pay_20_post_one_slice",
    oracle.branch("SELECT * FROM posted_payment", oracle.one_slice(*PAYMENT_SLICE)),
)
def pay_20_post_one_slice(spark, sf_dir):
    tables = fixtures.tables(spark, sf_dir, fixtures.PAYMENT_TABLES)
    slices = SliceSet.of(spark, [PAYMENT_SLICE])
    return posting.post_payments(tables, slices, CTX).drop(*ROW_COLUMNS)


@register(
    "pay_20_post_one_slice_company_3",
    oracle.branch("SELECT * FROM posted_payment", oracle.one_slice("2024-01-05", 3, "G")),
)
def pay_20_post_one_slice_company_3(spark, sf_dir):
    """Another company's card rates, also on the second system's forms."""
    tables = fixtures.tables(spark, sf_dir, fixtures.PAYMENT_TABLES)
    slices = SliceSet.of(spark, [("2024-01-05", 3, "G")])
    return posting.post_payments(tables, slices, CTX).drop(*ROW_COLUMNS)


@register(
    "pay_post_backfill",
    oracle.statement(
        "SELECT * EXCLUDE (slice_fecha, slice_empresa) FROM posted_payment",
        oracle.PAYMENTS_PRESENT,
    ),
)
def pay_post_backfill(spark, sf_dir):
    """Every slice that occurs in the payment forms or the payments, with its number."""
    tables = fixtures.tables(spark, sf_dir, fixtures.PAYMENT_TABLES)
    slices = SliceSet.present(
        (tables.payment_form, "fp_fecha", "fp_cod_empresa", "fp_estado"),
        (tables.payment, "p_fecha", "p_cod_empresa", "p_estado"),
    )
    return posting.post_payments(tables, slices, CTX).drop("slice_fecha", "slice_empresa")


# -- journal state ------------------------------------------------------------------


@register(
    "snk_01_replace_invoices",
    oracle.statement(
        """SELECT * FROM initial_journal
           WHERE in_tipo_documento IS DISTINCT FROM 6 OR in_cod_empresa IS DISTINCT FROM 1
           UNION ALL BY NAME
           SELECT * EXCLUDE (slice_id, slice_fecha, slice_empresa) FROM posted_invoice""",
        oracle.one_slice(*INVOICE_SLICE),
    ),
)
def snk_01_replace_invoices(spark, sf_dir):
    tables = fixtures.tables(spark, sf_dir, fixtures.INVOICE_TABLES)
    slices = SliceSet.of(spark, [INVOICE_SLICE])
    rows = post_invoices(tables, slices, CTX)
    return state.apply_invoice_runs(fixtures.initial_journal(spark, sf_dir), rows, slices)


@register(
    "snk_02_replace_payments",
    oracle.statement(
        """SELECT * FROM initial_journal
           WHERE in_tipo_documento = 6 OR in_cod_empresa IS DISTINCT FROM 1
           UNION ALL BY NAME
           SELECT * EXCLUDE (slice_id, slice_fecha, slice_empresa) FROM payment_row""",
        oracle.one_slice(*PAYMENT_SLICE),
    ),
)
def snk_02_replace_payments(spark, sf_dir):
    tables = fixtures.tables(spark, sf_dir, fixtures.PAYMENT_TABLES)
    slices = SliceSet.of(spark, [PAYMENT_SLICE])
    journal = fixtures.initial_journal(spark, sf_dir)
    cleared = state.clear_companies(journal, slices, state.is_other())
    return state.append_rows(cleared, payment_rows(tables, slices, CTX))


@register(
    "snk_03_purge_type5",
    oracle.statement(
        """SELECT * FROM initial_journal
           WHERE in_tipo_documento = 6 OR in_num_documento NOT IN (
               SELECT p_numero FROM purged JOIN slices ON p_dia = fecha)""",
        oracle.one_slice(*PAYMENT_SLICE),
    ),
)
def snk_03_purge_type5(spark, sf_dir):
    tables = fixtures.tables(spark, sf_dir, ["payment"])
    purged = state.purged_payments(tables.payment, SliceSet.of(spark, [PAYMENT_SLICE]))
    return state.purge_documents(fixtures.initial_journal(spark, sf_dir), purged, F.lit(True))


@register(
    "snk_04_purge_zero",
    oracle.statement(
        """SELECT * FROM initial_journal
           WHERE in_tipo_documento = 6 OR in_cod_empresa <> 1 OR in_valor <> 0
               OR in_valor IS NULL"""
    ),
)
def snk_04_purge_zero(spark, sf_dir):
    return state.purge_zeros(fixtures.initial_journal(spark, sf_dir), F.lit(1))


def _payment_state(before: str) -> dict[str, str]:
    return {"payment_state": oracle.ROWS["payment_state"].format(before=before)}


@register(
    "snk_invoices_state",
    oracle.statement("SELECT * EXCLUDE (slice_id) FROM invoice_state", oracle.INVOICE_MONTHS),
)
def snk_invoices_state(spark, sf_dir):
    """The journal after 498 invoice runs, in order."""
    tables = fixtures.tables(spark, sf_dir, fixtures.INVOICE_TABLES)
    journal = fixtures.initial_journal(spark, sf_dir)
    return posting.invoices_state(journal, tables, invoice_calendar(spark), CTX)


@register(
    "snk_payments_state",
    oracle.statement(
        "SELECT * EXCLUDE (slice_id, slice_empresa) FROM payment_state",
        oracle.PAYMENT_DAYS,
        _payment_state("initial_journal"),
    ),
)
def snk_payments_state(spark, sf_dir):
    """The journal after 180 payment runs, in order."""
    tables = fixtures.tables(spark, sf_dir, fixtures.PAYMENT_TABLES)
    journal = fixtures.initial_journal(spark, sf_dir)
    return posting.payments_state(journal, tables, payment_calendar(spark), CTX)


@register(
    "snk_payments_state_one_slice",
    oracle.statement(
        "SELECT * EXCLUDE (slice_id, slice_empresa) FROM payment_state",
        oracle.one_slice(*PAYMENT_SLICE),
        _payment_state("initial_journal"),
    ),
)
def snk_payments_state_one_slice(spark, sf_dir):
    """The journal after one payment run with all its steps."""
    tables = fixtures.tables(spark, sf_dir, fixtures.PAYMENT_TABLES)
    journal = fixtures.initial_journal(spark, sf_dir)
    slices = SliceSet.of(spark, [PAYMENT_SLICE])
    return posting.payments_state(journal, tables, slices, CTX)


# -- reversals ----------------------------------------------------------------------


def reversal_calendar(spark: SparkSession) -> SliceSet:
    """Every day of the reversal logs, for three companies."""
    calls = ((day, c) for day in fixtures.REVERSAL_DAYS for c in fixtures.COMPANIES)
    return reversals.reversal_calls(spark, calls)


def one_call(spark: SparkSession, company: int = 1) -> SliceSet:
    return reversals.reversal_calls(spark, [(REVERSAL_DATE, company)])


def _reversal(sources: tuple[str, ...]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = fixtures.tables(spark, sf_dir, fixtures.REVERSAL_TABLES)
        return reversals.reversed_documents(tables, reversal_calendar(spark), CTX, sources)

    return query


for name, source in (
    ("rvs_1_payments", "payments"),
    ("rvs_2_invoices", "invoices"),
    ("rvs_3_ext", "ext_payments"),
):
    register(name, oracle.statement(oracle.REVERSALS[source], oracle.REVERSAL_CALLS))(
        _reversal((source,))
    )
register(
    "rvs_4_documents",
    oracle.statement("SELECT * FROM reversed_document", oracle.REVERSAL_CALLS),
)(_reversal(reversals.SOURCES))


def _reversal_one_call(company: int) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = fixtures.tables(spark, sf_dir, fixtures.REVERSAL_TABLES)
        calls = one_call(spark, company)
        return reversals.reversed_documents(tables, calls, CTX).drop("llamada")

    return query


for name, company in (("rvs_4_documents_one_call", 1), ("rvs_4_documents_company_2", 2)):
    register(
        name,
        oracle.statement(
            "SELECT * EXCLUDE (llamada) FROM reversed_document",
            oracle.one_slice(REVERSAL_DATE, company, "R"),
        ),
    )(_reversal_one_call(company))


@register("rvs_5_dates", oracle.statement("SELECT * FROM reversal_date", oracle.REVERSAL_CALLS))
def rvs_5_dates(spark, sf_dir):
    documents = _reversal(reversals.SOURCES)(spark, sf_dir)
    return reversals.reversal_dates(documents)


@register(
    "rvs_6_replay",
    oracle.statement(
        """SELECT * EXCLUDE (slice_fecha, slice_empresa) FROM
           (SELECT * FROM posted_invoice UNION ALL BY NAME SELECT * FROM posted_payment)""",
        oracle.REPLAY,
        oracle.calls(oracle.one_slice(REVERSAL_DATE, 1, "R")),
    ),
)
def rvs_6_replay(spark, sf_dir):
    """The rows that each accounting date of one call posts, with the number of the date."""
    tables = fixtures.tables(spark, sf_dir)
    replay = posting.replay_reversals(tables, one_call(spark), CTX)
    return replay.journal_by_slice.drop("slice_fecha", "slice_empresa")


@register(
    "rvs_6_replay_all_calls",
    oracle.statement(
        """SELECT * EXCLUDE (slice_fecha, slice_empresa) FROM
           (SELECT * FROM posted_invoice UNION ALL BY NAME SELECT * FROM posted_payment)""",
        oracle.REPLAY,
        oracle.calls(oracle.REVERSAL_CALLS),
    ),
)
def rvs_6_replay_all_calls(spark, sf_dir):
    """The replays of every reversal date and company in one job."""
    tables = fixtures.tables(spark, sf_dir)
    replay = posting.replay_reversals(tables, reversal_calendar(spark), CTX)
    return replay.journal_by_slice.drop("slice_fecha", "slice_empresa")


@register(
    "rvs_6_final_state",
    oracle.statement(
        "SELECT * EXCLUDE (slice_id, slice_empresa) FROM payment_state",
        oracle.REPLAY,
        oracle.calls(oracle.one_slice(REVERSAL_DATE, 1, "R"))
        | _payment_state("(SELECT * EXCLUDE (slice_id) FROM invoice_state)"),
    ),
)
def rvs_6_final_state(spark, sf_dir):
    """The journal after the whole replay, in date order."""
    tables = fixtures.tables(spark, sf_dir)
    documents = reversals.reversed_documents(tables, one_call(spark), CTX)
    slices = reversals.reversal_slices(documents)
    journal = fixtures.initial_journal(spark, sf_dir)
    return posting.final_state(journal, tables, slices, CTX)


@register(
    "rvs_6_final_state_all_calls",
    oracle.statement(
        "SELECT * EXCLUDE (slice_id, slice_empresa) FROM payment_state",
        oracle.REPLAY,
        oracle.calls(oracle.REVERSAL_CALLS)
        | _payment_state("(SELECT * EXCLUDE (slice_id) FROM invoice_state)"),
    ),
)
def rvs_6_final_state_all_calls(spark, sf_dir):
    """The journal after the replays of every reversal date and company, in order."""
    tables = fixtures.tables(spark, sf_dir)
    slices = posting.replay_slices(tables, reversal_calendar(spark), CTX)[1]
    return posting.final_state(fixtures.initial_journal(spark, sf_dir), tables, slices, CTX)


def _stored_journal(spark: SparkSession, sf_dir: str) -> JournalTable:
    """The initial journal on files in the shared folder."""
    table = JournalTable(spark, new_path(spark, "catalogue-journal"))
    table.create(fixtures.initial_journal(spark, sf_dir))
    return table


@register("snk_journal_invoices", ORACLE["snk_invoices_state"])
def snk_journal_invoices(spark, sf_dir):
    """The journal on files after 498 invoice runs."""
    table = _stored_journal(spark, sf_dir)
    tables = fixtures.tables(spark, sf_dir, fixtures.INVOICE_TABLES)
    table.run_invoices(tables, invoice_calendar(spark), CTX)
    return table.read()


@register("snk_journal_payments", ORACLE["snk_payments_state"])
def snk_journal_payments(spark, sf_dir):
    """The journal on files after 180 payment runs."""
    table = _stored_journal(spark, sf_dir)
    tables = fixtures.tables(spark, sf_dir, fixtures.PAYMENT_TABLES)
    table.run_payments(tables, payment_calendar(spark), CTX)
    return table.read()


def _in_parts(slices: SliceSet, spark: SparkSession, parts: int) -> list[SliceSet]:
    """The slices in order, as several runs."""
    listed = list(slices.listed.values())
    size = -(-len(listed) // parts)
    return [SliceSet.of(spark, listed[at : at + size]) for at in range(0, len(listed), size)]


@register("snk_journal_invoices_in_parts", ORACLE["snk_invoices_state"])
def snk_journal_invoices_in_parts(spark, sf_dir):
    """The journal on files after 498 invoice runs, published as three versions."""
    table = _stored_journal(spark, sf_dir)
    tables = fixtures.tables(spark, sf_dir, fixtures.INVOICE_TABLES)
    for part in _in_parts(invoice_calendar(spark), spark, 3):
        table.run_invoices(tables, part, CTX)
    return table.read()


@register("snk_journal_payments_in_parts", ORACLE["snk_payments_state"])
def snk_journal_payments_in_parts(spark, sf_dir):
    """The journal on files after 180 payment runs, published as three versions, compacted after two."""
    table = _stored_journal(spark, sf_dir)
    tables = fixtures.tables(spark, sf_dir, fixtures.PAYMENT_TABLES)
    *first, last = _in_parts(payment_calendar(spark), spark, 3)
    for part in first:
        table.run_payments(tables, part, CTX)
    table.compact()
    table.run_payments(tables, last, CTX)
    return table.read()


@register("snk_journal_earlier_version", ORACLE["snk_invoices_state"])
def snk_journal_earlier_version(spark, sf_dir):
    """The journal as it was before its payment runs, read when they are published and merged."""
    table = _stored_journal(spark, sf_dir)
    tables = fixtures.tables(spark, sf_dir)
    table.run_invoices(tables, invoice_calendar(spark), CTX)
    version = table.manifest().version
    table.run_payments(tables, payment_calendar(spark), CTX)
    table.compact()
    return table.read(version)


@register("snk_journal_replay", ORACLE["rvs_6_final_state"])
def snk_journal_replay(spark, sf_dir):
    """The journal on files after a whole replay."""
    table = _stored_journal(spark, sf_dir)
    table.replay(fixtures.tables(spark, sf_dir), one_call(spark), CTX)
    return table.read()


# -- seeds and look-up --------------------------------------------------------------


def _seed(company: int) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        existing = fixtures.supplier_accounts(spark, sf_dir)
        return seeds.seed_payment_accounts(existing, company, fixtures.RUN_TS)

    return query


register("snk_05_seed_c3", oracle.seeded(3))(_seed(3))
register("snk_06_seed_c2", oracle.seeded(2))(_seed(2))


@register("fn_7_lookup", oracle.lookup())
def fn_7_lookup(spark, sf_dir):
    return seeds.lookup_accounts(fixtures.ledger_account(spark, sf_dir))
