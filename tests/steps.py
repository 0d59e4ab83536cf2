"""The steps of one run, written plainly and apart from the functions that runs use."""

from __future__ import annotations

from pyspark.sql import functions as F


def _without(journal, condition):
    return journal.filter(~F.coalesce(condition, F.lit(False)))


def clear_invoices(journal, company):
    return _without(journal, F.expr(f"in_tipo_documento = 6 AND in_cod_empresa = {company}"))


def clear_payments(journal, company):
    return _without(journal, F.expr(f"in_tipo_documento <> 6 AND in_cod_empresa = {company}"))


def purge_documents(journal, purged):
    listed = F.expr("in_tipo_documento <> 6 AND in_num_documento = purged")
    return journal.join(purged, listed, "left_anti")


def purge_zeros(journal, company):
    zero = f"in_valor = 0 AND in_tipo_documento <> 6 AND in_cod_empresa = {company}"
    return _without(journal, F.expr(zero))
