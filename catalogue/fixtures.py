"""Billing tables projected from the test tables.

Every projection keeps all rows of its source table or selects them by a plain attribute.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asiento.operators.seeds import map_rows, seed_rows
from asiento.sources.tables import Tables

RUN_TS = datetime(2024, 3, 1)

# Payment parameters of company 1 that no seed covers: account 9000000 + parameter.
COMPANY_1_PARAMS = (1, 2, 3, 6, 7, 8, 9, 10, 12, 13, 15, 24)

COMPANIES = (1, 2, 3)
STATES = ("G", "R")
INVOICE_MONTHS = [date(y, m, 1) for y in range(1995, 2002) for m in range(1, 13)][:-1]
REVERSAL_DAYS = [date(2024, 2, d) for d in range(1, 11)]
PAYMENT_DAYS = [date(2024, 1, d) for d in range(1, 31)]


# Given to the reader, so that no job looks into the files for them.
SOURCES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SOURCES[name]).parquet(f"{sf_dir}/{name}.parquet")


def invoice_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month starts, with hours so that truncation matters; NULL amounts and texts."""
    return read(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey de_numero",
        "l_linenumber de_num_linea",
        "l_partkey de_item",
        "l_suppkey % 3 + 1 de_cod_empresa",
        "cast(trunc(l_shipdate, 'MM') as timestamp_ntz) + make_dt_interval(0, l_linenumber) de_fecha",
        "if(l_returnflag = 'R', 'R', 'G') de_estado",
        "l_extendedprice de_subtotal",
        "l_extendedprice * l_tax de_itbis",
        "if(l_discount > 0.05D, l_extendedprice * l_discount, 0D) de_descuento_sa",
        "if(l_discount > 0.05D, l_extendedprice * l_discount * 0.8D, 0D) de_descuento_sa_bse",
        "if(l_linenumber % 3 = 0, l_extendedprice * 0.01D, 0D) de_descuento_lj",
        "case l_linenumber when 7 then null when 6 then 10D else 0D end de_monto_financiado",
        "l_extendedprice * (1 + l_tax) de_total",
        "1D de_cotizacion",
        "if(l_suppkey % 17 = 0, null, concat('ITEM ', l_partkey)) de_descripcion",
    )


def invoice_account_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No tax account for one brand, no receivable account for another, neither for LARGE;
    three insurers for parameter 14."""
    return read(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "p_brand",
        "p_type",
        "p_size",
        "inline(array(struct(1, 0), struct(2, 0), struct(3, 0), struct(11, 0),"
        " struct(12, 0), struct(13, 0), struct(14, 0), struct(14, 1), struct(14, 2),"
        " struct(15, 0)))",
    ).selectExpr(
        "p_partkey pf_id_producto",
        "col1 pf_id_parametro",
        "concat('4', lpad(cast(col1 * 1000 + p_size as string), 6, '0')) pf_cuenta",
        "if(col1 = 14, col2, null) pf_aseguradora",
        "p_brand",
        "p_type",
    ).filter(
        "not (pf_id_parametro = 15 and (p_brand = 'Brand#7' or p_type = 'LARGE'))"
        " and not (pf_id_parametro = 1 and p_brand = 'Brand#13')"
        " and not p_brand = 'Brand#21'"
    ).drop("p_brand", "p_type")


def invoice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey fa_numero",
        "o_orderdate fa_fecha",
        "o_custkey % 3 + 1 fa_cod_empresa",
        "o_custkey fa_ord_tra",
    )


def work_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insurers 0-4, of which the account map has 0-2."""
    return read(spark, sf_dir, "customer").selectExpr(
        "c_custkey ot_codigo", "c_nationkey % 5 ot_cia_seguros"
    )


def payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey p_numero",
        "case o_orderkey % 9 when 0 then 0 when 1 then 1 when 2 then 4 when 3 then 5 when 4 then 5"
        " when 5 then 6 when 6 then 2 when 7 then 5 else 3 end p_tipo_docum",
        "timestamp_ntz'2024-01-03 09:00:00' + make_dt_interval(cast(o_custkey % 5 as int)) p_fecha",
        "if(o_orderstatus = 'P', 'R', 'G') p_estado",
        "o_totalprice p_valor",
        "1D p_cotizacion",
        "o_custkey % 3 + 1 p_cod_empresa",
    )


def payment_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line's company is independent of the payment's."""
    return read(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey dp_num_pago",
        "l_orderkey dp_num_factura",
        "l_linenumber dp_linea",
        "l_extendedprice dp_valor",
        "l_suppkey % 3 + 1 dp_cod_empresa",
        "timestamp_ntz'2024-01-03 00:00:00' + make_dt_interval(cast(l_partkey % 5 as int))"
        " + make_dt_interval(0, l_linenumber) dp_fecha_documento",
    )


def payment_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten form codes, two currencies, zero and NULL amounts, NULL deposit dates, bank
    accounts without a mapping. Numbers meet payment numbers."""
    return read(spark, sf_dir, "events").selectExpr(
        "event_id fp_num_pago",
        "case event_id div 3 % 10 when 0 then 'TRJ' when 1 then 'DPC' when 2 then 'CHQ'"
        " when 3 then 'EFE' when 4 then 'NC' when 5 then 'CRC' when 6 then 'RTC'"
        " when 7 then 'RT1' when 8 then 'R5%' else 'CCA' end fp_forma_pago",
        "event_id % 3 + 1 fp_cod_empresa",
        "if(user_id % 4 = 0, 2, 1) fp_moneda",
        "if(user_id % 5 = 0, 'R', 'G') fp_estado",
        "case when event_id % 97 = 0 then 0D when event_id % 89 = 0 then null else value end fp_valor",
        "value / 58D fp_valor_bse",
        "if(user_id % 4 = 0, 58D, 1D) fp_cotizacion",
        "ts fp_fecha",
        "if(event_id % 11 = 0, null, ts - make_dt_interval(cast(event_id % 40 as int)))"
        " fp_fecha_deposito",
        "event_id % 27 fp_id_banco_cuenta",
    )


def ext_payment_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same forms as seen by the second system: no company, no base amount."""
    return payment_form(spark, sf_dir).drop("fp_cod_empresa", "fp_valor_bse")


def payment_account_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeds of companies 2 and 3, company 1, and a company for each supplier."""
    own = [(str(9000000 + p), f"P{p}", 1, p) for p in COMPANY_1_PARAMS]
    own.append(("2141005", "DEPOSITOS EN CTAS. BCO. NO IDENTIFICADOS", 1, 14))
    return (
        supplier_accounts(spark, sf_dir)
        .unionByName(map_rows(spark, own, RUN_TS))
        .unionByName(seed_rows(spark, 2, RUN_TS))
        .unionByName(seed_rows(spark, 3, RUN_TS))
    )


def supplier_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map rows of other companies, one per supplier; numbers from 100 on."""
    return read(spark, sf_dir, "supplier").select(
        F.expr("concat('7', lpad(cast(s_suppkey as string), 6, '0'))").alias("pp_cuenta"),
        F.col("s_name").alias("pp_descripcion_cta"),
        F.lit(RUN_TS).cast("timestamp_ntz").alias("pp_fecha"),
        F.expr("cast(100 + s_suppkey as int)").alias("pp_id_empresa"),
        F.col("s_nationkey").alias("pp_id_param"),
    )


def bank_account_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "nation").selectExpr(
        "n_nationkey bp_id",
        "concat('1111', lpad(cast(n_nationkey as string), 3, '0')) bp_cuenta_contable",
        "concat('U', n_regionkey) bp_uni_neg",
    )


def ledger_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bank accounts but one, and the accounts of two other units, named by suppliers."""
    banks = read(spark, sf_dir, "nation").selectExpr(
        "concat('1111', lpad(cast(n_nationkey as string), 3, '0')) cu_cuenta",
        "concat('U', n_regionkey) cu_uni_neg",
        "n_name cu_descripcion",
    ).filter("cu_cuenta <> '1111013'")
    units = read(spark, sf_dir, "supplier").selectExpr(
        "case s_suppkey % 8 when 0 then '1111005' when 1 then '1121001' when 2 then '2131003'"
        " when 3 then '2141004' when 4 then '4100001' when 5 then '4900002' when 6 then '1142005'"
        " else '2141005' end cu_cuenta",
        "if(s_nationkey < 12, 'HSI', 'OTR') cu_uni_neg",
        "s_name cu_descripcion",
    )
    return banks.unionByName(units)


def payment_reversal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").selectExpr(
        "o_orderkey rp_num_pago",
        "o_custkey % 3 + 1 rp_cod_empresa",
        "concat('U', o_custkey % 5) rp_user",
        "timestamp_ntz'2024-02-01 08:00:00' + make_dt_interval(cast(o_orderkey % 10 as int)) rp_fecha",
    )


def invoice_reversal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").selectExpr(
        "o_orderkey rv_num_factura",
        "o_custkey % 3 + 1 rv_cod_empresa",
        "concat('U', o_custkey % 5) rv_user",
        "timestamp_ntz'2024-02-01 08:00:00' + make_dt_interval(cast(o_orderkey % 10 as int)) rv_fecha",
    )


def ext_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey + 5000 p_numero",
        "timestamp_ntz'2024-01-03 09:00:00' + make_dt_interval(cast(o_custkey % 5 as int)) p_fecha",
    )


def ext_payment_reversal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").filter("o_orderstatus = 'O'").selectExpr(
        "o_orderkey + 5000 rp_num_pago",
        "concat('U', o_custkey % 5) rp_user",
        "timestamp_ntz'2024-02-01 08:00:00' + make_dt_interval(cast(o_orderkey % 10 as int)) rp_fecha",
    )


def initial_journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows the journal holds before a run: three document types, zeros and NULLs."""
    return read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey in_num_documento",
        "case o_orderkey % 3 when 0 then 6 when 1 then 0 else 4 end in_tipo_documento",
        "cast(null as string) in_cod_forma_pago",
        "cast(null as int) in_param",
        "case when o_orderkey % 50 = 0 then 0D when o_orderkey % 70 = 0 then null"
        " else o_totalprice end in_valor",
        "cast(null as string) in_cuenta",
        "cast(null as timestamp_ntz) in_fecha_ing",
        "cast(null as timestamp_ntz) in_fecha_cont",
        "cast(null as string) in_estado",
        "cast(null as string) in_terminal",
        "cast(null as string) in_operador",
        "cast(null as double) in_cotizacion",
        "cast(null as int) in_moneda",
        "cast(null as string) in_descripcion_reg",
        "cast(null as int) in_linea",
        "o_custkey % 3 + 1 in_cod_empresa",
        "cast(null as timestamp_ntz) in_fecha_facturaCXC",
        "cast(null as string) in_descripcion_cta",
    )


PROJECTIONS = {
    make.__name__: make
    for make in (
        invoice_line, invoice, work_order, invoice_account_map, payment, payment_line,
        payment_form, ext_payment_form, ext_payment, payment_account_map, bank_account_map,
        ledger_account, payment_reversal, invoice_reversal, ext_payment_reversal,
    )
}
INVOICE_TABLES = ("invoice_line", "invoice_account_map", "invoice", "work_order")
PAYMENT_TABLES = (
    "payment", "payment_line", "invoice", "payment_form", "ext_payment_form",
    "payment_account_map", "bank_account_map", "ledger_account",
)
REVERSAL_TABLES = (
    "payment_reversal", "payment", "invoice_reversal", "invoice", "ext_payment_reversal",
    "ext_payment",
)


def tables(spark: SparkSession, sf_dir: str, names: Iterable[str] = PROJECTIONS) -> Tables:
    return Tables(**{name: PROJECTIONS[name](spark, sf_dir) for name in set(names)})
