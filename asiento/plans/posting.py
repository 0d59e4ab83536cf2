"""The procedures a caller runs, composed from the operators."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asiento.context import RunContext
from asiento.operators.invoices import post_invoices
from asiento.operators.payments import payment_rows, settled_lines, unpurged_lines
from asiento.operators.reversals import reversal_slices, reversed_documents
from asiento.operators.state import (
    apply_invoice_runs,
    apply_payment_runs,
    not_cleared_later,
    purge_zeros,
    purged_at_last,
    purged_by_day,
    purged_payments,
    settle_payments,
)
from asiento.plans.rules import (
    EXT_BRANCHES,
    EXT_COMPANY,
    OWN_COMPANY_BRANCHES,
    REPLAY_COMPANY,
    REPLAY_USER,
)
from asiento.slices import SliceSet
from asiento.sources.tables import Tables


def post_payments(tables: Tables, slices: SliceSet, ctx: RunContext) -> DataFrame:
    """The rows each payment run posts and keeps after its own purges."""
    purged = purged_payments(tables.payment, slices)
    others = payment_rows(tables, slices, ctx, [*OWN_COMPANY_BRANCHES, *EXT_BRANCHES])
    lines = settled_lines(tables, slices, ctx, purged_by_day(purged))
    return settle_payments(others, purged).unionByName(purge_zeros(lines, F.col("slice_empresa")))


def journal_by_slice(tables: Tables, slices: SliceSet, ctx: RunContext) -> DataFrame:
    """The rows every slice posts, with its number; no slice clears another's rows."""
    invoices = post_invoices(tables, slices, ctx)
    payments = post_payments(tables, slices, ctx)
    return invoices.unionByName(payments, allowMissingColumns=True)


def lasting_invoices(tables: Tables, slices: SliceSet, ctx: RunContext) -> DataFrame:
    """The invoice rows that no later run of ``slices`` clears.

    A run posts rows of its own company only, so the last run of each company is enough:
    a backfill of years reads one date per company.
    """
    return post_invoices(tables, slices.last_of_companies(), ctx)


def lasting_payments(tables: Tables, slices: SliceSet, ctx: RunContext) -> DataFrame:
    """The rows of payments and forms that no later run of ``slices`` clears.

    Own forms and advances are of the run's company, and its last run is enough. Forms of
    the second system are of company 1 and last from its last run on.
    """
    own = payment_rows(tables, slices.last_of_companies(), ctx, OWN_COMPANY_BRANCHES)
    ext_slices = slices.since_last_of(EXT_COMPANY)
    ext = payment_rows(tables, ext_slices, ctx, EXT_BRANCHES)
    return own.unionByName(ext)


def lasting_lines(tables: Tables, slices: SliceSet, ctx: RunContext, purged: DataFrame) -> DataFrame:
    """The rows of payment lines that no later run of ``slices`` clears, and no run from their own on purges.

    Lines may be of any company: those of every run are compared with the later runs.
    """
    return not_cleared_later(unpurged_lines(tables, slices, ctx, purged_at_last(purged)), slices)


def invoices_state(
    journal: DataFrame, tables: Tables, slices: SliceSet, ctx: RunContext
) -> DataFrame:
    """The journal after the invoice runs of ``slices``, in order."""
    return apply_invoice_runs(journal, lasting_invoices(tables, slices, ctx), slices)


def payments_state(
    journal: DataFrame, tables: Tables, slices: SliceSet, ctx: RunContext
) -> DataFrame:
    """The journal after the payment runs of ``slices``, in order."""
    purged = purged_payments(tables.payment, slices)
    return apply_payment_runs(
        journal,
        lasting_payments(tables, slices, ctx),
        slices,
        purged,
        lasting_lines(tables, slices, ctx, purged),
    )


def final_state(
    journal: DataFrame, tables: Tables, slices: SliceSet, ctx: RunContext
) -> DataFrame:
    """The journal after every slice ran its invoices and its payments, in order.

    The two kinds of run touch disjoint rows, so each set is applied on its own.
    """
    return payments_state(invoices_state(journal, tables, slices, ctx), tables, slices, ctx)


@dataclass(frozen=True)
class Replay:
    """A replay of reversals: the documents, the slices, and the rows these post."""

    documents: DataFrame
    slices: SliceSet
    journal_by_slice: DataFrame


def replay_reversals(
    tables: Tables,
    calls: SliceSet,
    ctx: RunContext,
    replay_company: int | str = REPLAY_COMPANY,
) -> Replay:
    """Post again, as reversed, every accounting date of the documents each call finds.

    The dates are posted for company 1 and its fixed user whatever the company of the
    call is; ``replay_company="requested"`` posts them for the company of the call.
    """
    documents, slices, ctx = replay_slices(tables, calls, ctx, replay_company)
    return Replay(documents, slices, journal_by_slice(tables, slices, ctx))


def replay_slices(
    tables: Tables,
    calls: SliceSet,
    ctx: RunContext,
    replay_company: int | str = REPLAY_COMPANY,
) -> tuple[DataFrame, SliceSet, RunContext]:
    """Documents of a replay, the slices it posts, and the parameters it posts them with."""
    documents = reversed_documents(tables, calls, ctx)
    target = None if replay_company == "requested" else int(replay_company)
    return documents, reversal_slices(documents, target), replace(ctx, user=REPLAY_USER)
