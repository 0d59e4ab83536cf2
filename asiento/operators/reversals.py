"""Reversed documents, and the slices that post their accounting dates again."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from asiento.context import RunContext
from asiento.plans.rules import EXT_COMPANY, REPLAY_COMPANY, REVERSED
from asiento.slices import Slice, SliceSet
from asiento.sources.shared import unsized
from asiento.sources.tables import Tables

SOURCES = ("payments", "invoices", "ext_payments")

# More than there are days from year 1 to year 9999.
DATES_PER_CALL = 10_000_000


def reversal_calls(
    spark: SparkSession, calls: Iterable[tuple[date | datetime | str, int]]
) -> SliceSet:
    """Replay calls (reversal date, company), numbered 1..n in the order given."""
    return SliceSet.of(spark, (Slice(day, company, REVERSED) for day, company in calls))


def reversed_documents(
    tables: Tables, calls: SliceSet, ctx: RunContext, sources: Iterable[str] = SOURCES
) -> DataFrame:
    """Documents that each call finds reversed, with their accounting date.

    ``llamada`` is the number of the call.
    """
    parts = []
    for source in sources:
        if source == "payments":
            log = calls.select_from(tables.payment_reversal, ctx, "rp_fecha", "rp_cod_empresa")
            parts.append(_payments(log, tables.payment, F.col("rp_cod_empresa")))
        elif source == "invoices":
            log = calls.select_from(tables.invoice_reversal, ctx, "rv_fecha", "rv_cod_empresa")
            invoices = tables.invoice.select("fa_numero", "fa_fecha")
            parts.append(
                log.join(unsized(invoices), F.col("rv_num_factura") == F.col("fa_numero")).select(
                    *_document("rv_num_factura", "fa_fecha", F.col("rv_cod_empresa"), "rv_user")
                )
            )
        elif source == "ext_payments":
            # The second system's log has no company: all of it belongs to one, and the
            # planner drops this part when no call is for that company.
            of_company = calls.for_company(EXT_COMPANY)
            log = of_company.select_from(tables.ext_payment_reversal, ctx, "rp_fecha")
            parts.append(_payments(log, tables.ext_payment, F.lit(EXT_COMPANY)))
        else:
            raise ValueError(f"unknown source of reversals: {source}")
    documents = parts[0]
    for part in parts[1:]:
        documents = documents.unionByName(part)
    return documents


def _payments(log: DataFrame, payments: DataFrame, company: Column) -> DataFrame:
    found = payments.select("p_numero", "p_fecha")
    return log.join(unsized(found), F.col("rp_num_pago") == F.col("p_numero")).select(
        *_document("rp_num_pago", "p_fecha", company, "rp_user")
    )


def _document(number: str, accounted: str, company: Column, user: str) -> list[Column]:
    return [
        F.col("slice_id").alias("llamada"),
        F.col(number).alias("num_doc"),
        F.to_date(accounted).alias("fecha_contable"),
        company.cast("int").alias("empresa"),
        F.col(user).alias("usuario"),
    ]


def reversal_dates(documents: DataFrame) -> DataFrame:
    """Distinct accounting dates of each call, numbered from 1 in ascending order.

    The numbering sees one row per calendar day, whatever the number of documents.
    """
    dates = documents.select(
        "llamada", "empresa", F.col("fecha_contable").alias("fecha")
    ).distinct()
    order = Window.partitionBy("llamada").orderBy(F.col("fecha").asc_nulls_first())
    return dates.select("llamada", "empresa", F.row_number().over(order).alias("id"), "fecha")


def reversal_slices(documents: DataFrame, company: int | None = REPLAY_COMPANY) -> SliceSet:
    """One slice per call and accounting date, in state 'reversed', in call and date order.

    Documents are collected for the company of the call but replayed for company 1; pass
    ``company`` to replay another, or None to replay the company of the call.
    """
    number = (F.col("llamada") - 1) * DATES_PER_CALL + F.col("id")
    empresa = F.col("empresa") if company is None else F.lit(company)
    return SliceSet.from_frame(
        reversal_dates(documents).select(
            number.cast("bigint").alias("slice_id"),
            "fecha",
            empresa.alias("empresa"),
            F.lit(REVERSED).alias("estado"),
        )
    )
