"""Seed rows of the payment account map, and the look-up in the chart of accounts."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asiento.context import RunContext

# Fixed values: (account, text, parameter) of each seeded company.
SEEDS = {
    3: (
        ("1121001", "CTAS X COBRAR CLIENTES", 1),
        ("1142005", "ITBIS RETENIDO CARDNET", 2),
        ("5800004", "COMISIONES CARDNET", 3),
        ("1112003", "PRIMA CTA AHORRO US$", 6),
        ("4900001", "DESC. POR N/C SERV.DEL PINTADO", 7),
        ("2141006", "AVANCES DE CLIENTES", 8),
        ("2131003", "ITBIS COBRADO", 10),
        ("2141005", "DEPOSITOS EN CTAS. BCO. NO IDENTIFICADOS", 14),
    ),
    2: (
        ("1121001", "CTAS X COBRAR CLIENTES", 1),
        ("1142005", "ITBIS RETENIDO CARDNET", 2),
        ("5800004", "COMISIONES CARDNET", 3),
        ("1112003", "PRIMA CTA AHORRO US$", 6),
        ("4900002", "DESC. POR  N/C A  FACT. EN SERV. DE SEGURIDAD", 7),
        ("2141004", "INSTALACIONES PENDIENTES / PAGOS ANTICIPADOS", 8),
        ("2131003", "ITBIS COBRADO", 10),
        ("2141005", "DEPOSITOS EN CTAS. BCO. NO IDENTIFICADOS", 14),
    ),
}

# The accounts looked up after seeding company 2, and their business unit.
LOOKUP_ACCOUNTS = ("1111005", "1121001", "1142011", "2131003", "2141004", "4100001", "4900002")
LOOKUP_UNIT = "HSI"


def map_rows(
    spark: SparkSession, rows: Iterable[tuple[str, str, int, int]], run_ts: datetime
) -> DataFrame:
    """Account map rows from (account, text, company, parameter)."""
    accounts, texts, companies, params = zip(*rows, strict=True)
    return spark.createDataFrame(
        pa.table(
            {
                "pp_cuenta": pa.array(accounts, pa.string()),
                "pp_descripcion_cta": pa.array(texts, pa.string()),
                "pp_id_empresa": pa.array(companies, pa.int32()),
                "pp_id_param": pa.array(params, pa.int32()),
            }
        )
    ).select(
        "pp_cuenta",
        "pp_descripcion_cta",
        F.lit(run_ts).cast("timestamp_ntz").alias("pp_fecha"),
        "pp_id_empresa",
        "pp_id_param",
    )


def seed_rows(spark: SparkSession, company: int, run_ts: datetime) -> DataFrame:
    rows = ((account, text, company, param) for account, text, param in SEEDS[company])
    return map_rows(spark, rows, run_ts)


def seed_payment_accounts(
    account_map: DataFrame, company: int, run_ts: datetime, upsert: bool = False
) -> DataFrame:
    """The map with a company's seed rows appended.

    Appending twice doubles the rows, and with them every posting; ``upsert`` replaces
    rows of the same company and parameter instead.
    """
    seeds = seed_rows(account_map.sparkSession, company, run_ts)
    kept = account_map
    if upsert:
        kept = account_map.join(
            seeds.select("pp_id_empresa", "pp_id_param"),
            ["pp_id_empresa", "pp_id_param"],
            "left_anti",
        ).select(*account_map.columns)
    return kept.unionByName(seeds)


def lookup_accounts(
    ledger: DataFrame,
    accounts: Iterable[str] = LOOKUP_ACCOUNTS,
    unit: str = LOOKUP_UNIT,
    ctx: RunContext | None = None,
) -> DataFrame:
    """Rows of the chart of accounts, all columns, for some accounts of one unit."""
    ctx = ctx or RunContext()
    account = ctx.text(F.col("cu_cuenta"))
    if ctx.collation is None:
        listed = account.isin(list(accounts))
    else:
        listed = F.lit(False)
        for code in accounts:
            listed = listed | (account == code)
    return ledger.filter(listed & (ctx.text(F.col("cu_uni_neg")) == unit))
