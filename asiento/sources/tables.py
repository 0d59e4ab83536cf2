"""The input tables of the engine, read from files or from a catalog."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

from asiento.sources import schemas
from asiento.sources.schemas import check_columns

SCHEMAS = {
    "invoice_line": schemas.INVOICE_LINE,
    "invoice": schemas.INVOICE,
    "work_order": schemas.WORK_ORDER,
    "invoice_account_map": schemas.INVOICE_ACCOUNT_MAP,
    "payment": schemas.PAYMENT,
    "payment_line": schemas.PAYMENT_LINE,
    "payment_form": schemas.PAYMENT_FORM,
    "ext_payment_form": schemas.EXT_PAYMENT_FORM,
    "ext_payment": schemas.EXT_PAYMENT,
    "payment_account_map": schemas.PAYMENT_ACCOUNT_MAP,
    "bank_account_map": schemas.BANK_ACCOUNT_MAP,
    "ledger_account": schemas.LEDGER_ACCOUNT,
    "payment_reversal": schemas.PAYMENT_REVERSAL,
    "invoice_reversal": schemas.INVOICE_REVERSAL,
    "ext_payment_reversal": schemas.EXT_PAYMENT_REVERSAL,
}


@dataclass(frozen=True)
class Tables:
    """One DataFrame per input table; a job needs only those its operators read."""

    invoice_line: DataFrame | None = None
    invoice: DataFrame | None = None
    work_order: DataFrame | None = None
    invoice_account_map: DataFrame | None = None
    payment: DataFrame | None = None
    payment_line: DataFrame | None = None
    payment_form: DataFrame | None = None
    ext_payment_form: DataFrame | None = None
    ext_payment: DataFrame | None = None
    payment_account_map: DataFrame | None = None
    bank_account_map: DataFrame | None = None
    ledger_account: DataFrame | None = None
    payment_reversal: DataFrame | None = None
    invoice_reversal: DataFrame | None = None
    ext_payment_reversal: DataFrame | None = None

    def __post_init__(self):
        for field in fields(self):
            df = getattr(self, field.name)
            if df is not None:
                check_columns(df, SCHEMAS[field.name], field.name)

    @staticmethod
    def from_parquet(spark: SparkSession, paths: Mapping[str, str]) -> Tables:
        """Tables by name from parquet files or folders."""
        return Tables(**{name: spark.read.parquet(path) for name, path in paths.items()})

    @staticmethod
    def from_catalog(spark: SparkSession, names: Mapping[str, str]) -> Tables:
        """Tables by name from the catalog; each may live in its own database."""
        return Tables(**{name: spark.table(table) for name, table in names.items()})
