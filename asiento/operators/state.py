"""What posting runs do to the journal.

A run first clears the journal's rows of its company and document class, for every date
and state, then appends its own rows. A payment run finally purges the documents of type-5
payments of its date, whatever their company, and the zero amounts of its company.

Several runs are applied at once. A row stays if no later run, and no later step of its
own run, deletes it; that needs two anti joins however many runs there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asiento.functions.predicates import definitely
from asiento.plans.rules import INVOICE_DOCUMENT, PURGED_DOCUMENT
from asiento.slices import ROW_COLUMNS, SliceSet
from asiento.sources.schemas import JOURNAL


def is_invoice() -> Column:
    return F.col("in_tipo_documento") == INVOICE_DOCUMENT


def is_other() -> Column:
    """Any other document; NULL for a row without type, which no run deletes."""
    return F.col("in_tipo_documento") != INVOICE_DOCUMENT


# -- steps --------------------------------------------------------------------------


def clear_companies(journal: DataFrame, slices: SliceSet, affected: Column) -> DataFrame:
    """Delete the rows of the slices' companies that are ``affected``, of any date and state."""
    runs = slices.companies().select(F.col("empresa").alias("run_empresa"))
    return journal.join(
        runs, affected & (F.col("in_cod_empresa") == F.col("run_empresa")), "left_anti"
    )


def append_rows(journal: DataFrame, rows: DataFrame) -> DataFrame:
    """Append a run's rows; columns the run does not set are NULL."""
    return journal.unionByName(rows.drop(*ROW_COLUMNS), allowMissingColumns=True).select(
        *JOURNAL.names
    )


def purged_payments(payments: DataFrame, slices: SliceSet) -> DataFrame:
    """Type-5 payments of the slices' dates, with the date and last run that purge them."""
    last_run = slices.df.groupBy(F.col("fecha").alias("run_fecha")).agg(
        F.max("slice_id").alias("last_run")
    )
    return (
        payments.filter((F.col("p_tipo_docum") == PURGED_DOCUMENT) & slices.on_dates(payments, "p_fecha"))
        .join(last_run, F.to_date("p_fecha") == F.col("run_fecha"))
        .select(F.col("p_numero").alias("purged"), F.col("run_fecha").alias("purged_on"), "last_run")
    )


def purge_documents(journal: DataFrame, purged: DataFrame, run: Column) -> DataFrame:
    """Delete non-invoice rows whose document is in the list, whatever their company.

    ``run`` says which of the runs that purge a document come after the row.
    """
    listed = is_other() & (F.col("in_num_documento") == F.col("purged"))
    return journal.join(purged, listed & run, "left_anti")


def purge_zeros(rows: DataFrame, company: Column) -> DataFrame:
    """Delete non-invoice rows of the run's ``company`` that amount to zero; NULL amounts stay."""
    zero = (F.col("in_valor") == 0) & is_other() & (F.col("in_cod_empresa") == company)
    return rows.filter(~definitely(zero))


# -- runs ---------------------------------------------------------------------------


def purged_by_day(purged: DataFrame) -> DataFrame:
    """Each purged document once for each date, with the last run of the date."""
    # Grouped by the join's keys: repeated payments shrink before they move.
    return purged.groupBy("purged", "purged_on").agg(F.max("last_run").alias("last_run")).hint("merge")


def purged_at_last(purged: DataFrame) -> DataFrame:
    """Each purged document once, with the last run that purges it.

    Sorted, never broadcast: in files these numbers take a small part of what they take in memory.
    """
    return purged.groupBy("purged").agg(F.max("last_run").alias("last_run")).hint("merge")


def settle_payments(rows: DataFrame, purged: DataFrame) -> DataFrame:
    """What each payment run leaves of its own rows, run by run."""
    kept = purge_zeros(rows, F.col("slice_empresa"))
    return purge_documents(kept, purged_by_day(purged), F.col("purged_on") == F.col("slice_fecha"))


def not_cleared_later(rows: DataFrame, slices: SliceSet) -> DataFrame:
    """Rows of runs that no later run clears, which is one of the row's company."""
    last_run = slices.df.groupBy(F.col("empresa").alias("run_empresa")).agg(
        F.max("slice_id").alias("last_run")
    )
    cleared = (F.col("in_cod_empresa") == F.col("run_empresa")) & (
        F.col("last_run") > F.col("slice_id")
    )
    return rows.join(last_run, cleared, "left_anti")


def apply_invoice_runs(journal: DataFrame, rows: DataFrame, slices: SliceSet) -> DataFrame:
    """The journal after the invoice runs of ``slices``, in their order.

    ``rows`` are those of the runs' rows that no later run clears.
    """
    return append_rows(clear_companies(journal, slices, is_invoice()), rows)


def apply_payment_runs(
    journal: DataFrame, rows: DataFrame, slices: SliceSet, purged: DataFrame, lines: DataFrame | None = None
) -> DataFrame:
    """The journal after the payment runs of ``slices``, in their order.

    ``rows`` are those of the runs' rows that no later run clears; ``purged`` comes from
    ``purged_payments`` for the same slices. Old rows carry a NULL ``slice_id``: they
    precede every run. ``lines`` are rows whose documents are purged already.
    """
    remaining = clear_companies(journal, slices, is_other()).unionByName(
        purge_zeros(rows, F.col("slice_empresa")), allowMissingColumns=True
    )
    since = F.col("slice_id").isNull() | (F.col("last_run") >= F.col("slice_id"))
    after = purge_documents(remaining, purged_at_last(purged), since)
    if lines is not None:
        after = after.unionByName(purge_zeros(lines, F.col("slice_empresa")), allowMissingColumns=True)
    return after.select(*JOURNAL.names)
