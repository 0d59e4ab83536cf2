"""SQL that DuckDB runs on the same parquet tables, one statement per named query.

Each branch is a statement of its own, with its own scan and join; the engine's merged
plans are checked against the sum of them.
"""

from __future__ import annotations

import re
from functools import cache

# Fixed values, stated here apart from the engine: seeded accounts of companies 3 and 2, and the
# accounts that are looked up.
SEEDS = {
    3: [
        ("1121001", "CTAS X COBRAR CLIENTES", 1),
        ("1142005", "ITBIS RETENIDO CARDNET", 2),
        ("5800004", "COMISIONES CARDNET", 3),
        ("1112003", "PRIMA CTA AHORRO US$", 6),
        ("4900001", "DESC. POR N/C SERV.DEL PINTADO", 7),
        ("2141006", "AVANCES DE CLIENTES", 8),
        ("2131003", "ITBIS COBRADO", 10),
        ("2141005", "DEPOSITOS EN CTAS. BCO. NO IDENTIFICADOS", 14),
    ],
    2: [
        ("1121001", "CTAS X COBRAR CLIENTES", 1),
        ("1142005", "ITBIS RETENIDO CARDNET", 2),
        ("5800004", "COMISIONES CARDNET", 3),
        ("1112003", "PRIMA CTA AHORRO US$", 6),
        ("4900002", "DESC. POR  N/C A  FACT. EN SERV. DE SEGURIDAD", 7),
        ("2141004", "INSTALACIONES PENDIENTES / PAGOS ANTICIPADOS", 8),
        ("2131003", "ITBIS COBRADO", 10),
        ("2141005", "DEPOSITOS EN CTAS. BCO. NO IDENTIFICADOS", 14),
    ],
}
LOOKUP_ACCOUNTS = ["1111005", "1121001", "1142011", "2131003", "2141004", "4100001", "4900002"]
LOOKUP_UNIT = "HSI"
from catalogue.fixtures import COMPANY_1_PARAMS

RUN_TS = "TIMESTAMP '2024-03-01 00:00:00'"

# -- input tables -------------------------------------------------------------------


def _seed_values(company: int) -> str:
    return ", ".join(
        f"('{account}', '{text}', {company}, {param})" for account, text, param in SEEDS[company]
    )


_COMPANY_1 = ", ".join(
    [f"('{9000000 + p}', 'P{p}', 1, {p})" for p in COMPANY_1_PARAMS]
    + ["('2141005', 'DEPOSITOS EN CTAS. BCO. NO IDENTIFICADOS', 1, 14)"]
)


def _map_values(values: str) -> str:
    return (
        "SELECT a AS pp_cuenta, t AS pp_descripcion_cta, "
        f"{RUN_TS} AS pp_fecha, c AS pp_id_empresa, p AS pp_id_param "
        f"FROM (VALUES {values}) v(a, t, c, p)"
    )


TABLES = {
    "invoice_line": """
        SELECT l_orderkey AS de_numero, l_linenumber AS de_num_linea, l_partkey AS de_item,
            l_suppkey % 3 + 1 AS de_cod_empresa,
            date_trunc('month', l_shipdate)::TIMESTAMP + to_hours(l_linenumber::BIGINT) AS de_fecha,
            CASE WHEN l_returnflag = 'R' THEN 'R' ELSE 'G' END AS de_estado,
            l_extendedprice AS de_subtotal,
            l_extendedprice * l_tax AS de_itbis,
            CASE WHEN l_discount > 0.05::DOUBLE THEN l_extendedprice * l_discount
                ELSE 0::DOUBLE END AS de_descuento_sa,
            CASE WHEN l_discount > 0.05::DOUBLE THEN l_extendedprice * l_discount * 0.8::DOUBLE
                ELSE 0::DOUBLE END AS de_descuento_sa_bse,
            CASE WHEN l_linenumber % 3 = 0 THEN l_extendedprice * 0.01::DOUBLE
                ELSE 0::DOUBLE END AS de_descuento_lj,
            CASE l_linenumber WHEN 7 THEN NULL WHEN 6 THEN 10::DOUBLE
                ELSE 0::DOUBLE END AS de_monto_financiado,
            l_extendedprice * (1 + l_tax) AS de_total,
            1::DOUBLE AS de_cotizacion,
            CASE WHEN l_suppkey % 17 = 0 THEN NULL
                ELSE 'ITEM ' || l_partkey END AS de_descripcion
        FROM lineitem""",
    "invoice_account_map": """
        SELECT p_partkey AS pf_id_producto, v.prm AS pf_id_parametro,
            '4' || lpad((v.prm * 1000 + p_size)::VARCHAR, 6, '0') AS pf_cuenta,
            CASE WHEN v.prm = 14 THEN v.aseg END AS pf_aseguradora
        FROM part CROSS JOIN (VALUES (1, 0), (2, 0), (3, 0), (11, 0), (12, 0), (13, 0),
            (14, 0), (14, 1), (14, 2), (15, 0)) v(prm, aseg)
        WHERE p_brand <> 'Brand#21'
            AND (v.prm <> 15 OR (p_brand <> 'Brand#7' AND p_type <> 'LARGE'))
            AND (v.prm <> 1 OR p_brand <> 'Brand#13')""",
    "invoice": """
        SELECT o_orderkey AS fa_numero, o_orderdate AS fa_fecha,
            o_custkey % 3 + 1 AS fa_cod_empresa, o_custkey AS fa_ord_tra
        FROM orders""",
    "work_order": """
        SELECT c_custkey AS ot_codigo, c_nationkey % 5 AS ot_cia_seguros FROM customer""",
    "payment": """
        SELECT o_orderkey AS p_numero,
            CASE o_orderkey % 9 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 4 WHEN 3 THEN 5
                WHEN 4 THEN 5 WHEN 5 THEN 6 WHEN 6 THEN 2 WHEN 7 THEN 5 ELSE 3 END AS p_tipo_docum,
            TIMESTAMP '2024-01-03 09:00:00' + to_days((o_custkey % 5)::INTEGER) AS p_fecha,
            CASE WHEN o_orderstatus = 'P' THEN 'R' ELSE 'G' END AS p_estado,
            o_totalprice AS p_valor, 1::DOUBLE AS p_cotizacion,
            o_custkey % 3 + 1 AS p_cod_empresa
        FROM orders""",
    "payment_line": """
        SELECT l_orderkey AS dp_num_pago, l_orderkey AS dp_num_factura,
            l_linenumber AS dp_linea, l_extendedprice AS dp_valor,
            l_suppkey % 3 + 1 AS dp_cod_empresa,
            TIMESTAMP '2024-01-03 00:00:00' + to_days((l_partkey % 5)::INTEGER)
                + to_hours(l_linenumber::BIGINT) AS dp_fecha_documento
        FROM lineitem""",
    "payment_form": """
        SELECT event_id AS fp_num_pago,
            CASE (event_id // 3) % 10 WHEN 0 THEN 'TRJ' WHEN 1 THEN 'DPC' WHEN 2 THEN 'CHQ'
                WHEN 3 THEN 'EFE' WHEN 4 THEN 'NC' WHEN 5 THEN 'CRC' WHEN 6 THEN 'RTC'
                WHEN 7 THEN 'RT1' WHEN 8 THEN 'R5%' ELSE 'CCA' END AS fp_forma_pago,
            event_id % 3 + 1 AS fp_cod_empresa,
            CASE WHEN user_id % 4 = 0 THEN 2 ELSE 1 END AS fp_moneda,
            CASE WHEN user_id % 5 = 0 THEN 'R' ELSE 'G' END AS fp_estado,
            CASE WHEN event_id % 97 = 0 THEN 0::DOUBLE WHEN event_id % 89 = 0 THEN NULL
                ELSE value END AS fp_valor,
            value / 58::DOUBLE AS fp_valor_bse,
            CASE WHEN user_id % 4 = 0 THEN 58::DOUBLE ELSE 1::DOUBLE END AS fp_cotizacion,
            ts AS fp_fecha,
            CASE WHEN event_id % 11 = 0 THEN NULL
                ELSE ts - to_days((event_id % 40)::INTEGER) END AS fp_fecha_deposito,
            event_id % 27 AS fp_id_banco_cuenta
        FROM events""",
    "ext_payment_form": """
        SELECT * EXCLUDE (fp_cod_empresa, fp_valor_bse) FROM payment_form""",
    "supplier_accounts": f"""
        SELECT '7' || lpad(s_suppkey::VARCHAR, 6, '0') AS pp_cuenta,
            s_name AS pp_descripcion_cta, {RUN_TS} AS pp_fecha,
            (100 + s_suppkey)::INTEGER AS pp_id_empresa, s_nationkey AS pp_id_param
        FROM supplier""",
    "payment_account_map": f"""
        SELECT * FROM supplier_accounts
        UNION ALL {_map_values(", ".join([_COMPANY_1, _seed_values(2), _seed_values(3)]))}""",
    "bank_account_map": """
        SELECT n_nationkey AS bp_id, '1111' || lpad(n_nationkey::VARCHAR, 3, '0') AS bp_cuenta_contable,
            'U' || n_regionkey AS bp_uni_neg
        FROM nation""",
    "ledger_account": """
        SELECT '1111' || lpad(n_nationkey::VARCHAR, 3, '0') AS cu_cuenta,
            'U' || n_regionkey AS cu_uni_neg, n_name AS cu_descripcion
        FROM nation WHERE n_nationkey <> 13
        UNION ALL
        SELECT CASE s_suppkey % 8 WHEN 0 THEN '1111005' WHEN 1 THEN '1121001' WHEN 2 THEN '2131003'
                WHEN 3 THEN '2141004' WHEN 4 THEN '4100001' WHEN 5 THEN '4900002'
                WHEN 6 THEN '1142005' ELSE '2141005' END,
            CASE WHEN s_nationkey < 12 THEN 'HSI' ELSE 'OTR' END, s_name
        FROM supplier""",
    "payment_reversal": """
        SELECT o_orderkey AS rp_num_pago, o_custkey % 3 + 1 AS rp_cod_empresa,
            'U' || (o_custkey % 5) AS rp_user,
            TIMESTAMP '2024-02-01 08:00:00' + to_days((o_orderkey % 10)::INTEGER) AS rp_fecha
        FROM orders WHERE o_orderstatus = 'P'""",
    "invoice_reversal": """
        SELECT o_orderkey AS rv_num_factura, o_custkey % 3 + 1 AS rv_cod_empresa,
            'U' || (o_custkey % 5) AS rv_user,
            TIMESTAMP '2024-02-01 08:00:00' + to_days((o_orderkey % 10)::INTEGER) AS rv_fecha
        FROM orders WHERE o_orderstatus = 'F'""",
    "ext_payment": """
        SELECT o_orderkey + 5000 AS p_numero,
            TIMESTAMP '2024-01-03 09:00:00' + to_days((o_custkey % 5)::INTEGER) AS p_fecha
        FROM orders""",
    "ext_payment_reversal": """
        SELECT o_orderkey + 5000 AS rp_num_pago, 'U' || (o_custkey % 5) AS rp_user,
            TIMESTAMP '2024-02-01 08:00:00' + to_days((o_orderkey % 10)::INTEGER) AS rp_fecha
        FROM orders WHERE o_orderstatus = 'O'""",
    "initial_journal": """
        SELECT o_orderkey AS in_num_documento,
            CASE o_orderkey % 3 WHEN 0 THEN 6 WHEN 1 THEN 0 ELSE 4 END AS in_tipo_documento,
            NULL::VARCHAR AS in_cod_forma_pago, NULL::INTEGER AS in_param,
            CASE WHEN o_orderkey % 50 = 0 THEN 0::DOUBLE WHEN o_orderkey % 70 = 0 THEN NULL
                ELSE o_totalprice END AS in_valor,
            NULL::VARCHAR AS in_cuenta, NULL::TIMESTAMP AS in_fecha_ing,
            NULL::TIMESTAMP AS in_fecha_cont, NULL::VARCHAR AS in_estado,
            NULL::VARCHAR AS in_terminal, NULL::VARCHAR AS in_operador,
            NULL::DOUBLE AS in_cotizacion, NULL::INTEGER AS in_moneda,
            NULL::VARCHAR AS in_descripcion_reg, NULL::INTEGER AS in_linea,
            o_custkey % 3 + 1 AS in_cod_empresa, NULL::TIMESTAMP AS in_fecha_facturaCXC,
            NULL::VARCHAR AS in_descripcion_cta
        FROM orders""",
}

# -- slices -------------------------------------------------------------------------


def _calendar(first: str, last: str, step: str) -> str:
    return f"""
        SELECT row_number() OVER (ORDER BY d.fecha, e.empresa, t.estado) AS slice_id,
            d.fecha::DATE AS fecha, e.empresa, t.estado
        FROM generate_series(DATE '{first}', DATE '{last}', INTERVAL 1 {step}) d(fecha)
        CROSS JOIN (VALUES (1), (2), (3)) e(empresa)
        CROSS JOIN (VALUES ('G'), ('R')) t(estado)"""


INVOICE_MONTHS = _calendar("1995-01-01", "2001-11-01", "MONTH")
PAYMENT_DAYS = _calendar("2024-01-01", "2024-01-30", "DAY")


def one_slice(fecha: str, empresa: int, estado: str) -> str:
    return (
        f"SELECT 1::BIGINT AS slice_id, DATE '{fecha}' AS fecha, "
        f"{empresa} AS empresa, '{estado}' AS estado"
    )


_NAMED = """
    SELECT strftime(fecha, '%Y-%m-%d') || '|' || lpad(empresa::VARCHAR, 10, '0') || '|' || estado
            AS slice_id, fecha, empresa, estado
    FROM ({found})
    WHERE fecha IS NOT NULL AND empresa IS NOT NULL AND estado IS NOT NULL"""
INVOICES_PRESENT = _NAMED.format(
    found="SELECT DISTINCT de_fecha::DATE AS fecha, de_cod_empresa AS empresa, de_estado AS estado"
    " FROM invoice_line"
)
PAYMENTS_PRESENT = _NAMED.format(
    found="SELECT fp_fecha::DATE AS fecha, fp_cod_empresa AS empresa, fp_estado AS estado"
    " FROM payment_form UNION SELECT p_fecha::DATE, p_cod_empresa, p_estado FROM payment"
)

# -- rows ---------------------------------------------------------------------------

INVOICE_LINES = """
    SELECT l.*, s.slice_id, s.fecha AS slice_fecha, s.empresa AS slice_empresa
    FROM invoice_line l, slices s
    WHERE l.de_fecha::DATE = s.fecha AND l.de_cod_empresa = s.empresa AND l.de_estado = s.estado"""
FORMS = """
    SELECT f.*, f.fp_cod_empresa AS empresa, s.slice_id, s.fecha AS slice_fecha,
        s.empresa AS slice_empresa
    FROM payment_form f, slices s
    WHERE f.fp_fecha::DATE = s.fecha AND f.fp_cod_empresa = s.empresa AND f.fp_estado = s.estado"""
EXT_FORMS = """
    SELECT f.*, 1 AS empresa, s.slice_id, s.fecha AS slice_fecha, s.empresa AS slice_empresa
    FROM ext_payment_form f, slices s
    WHERE f.fp_fecha::DATE = s.fecha AND f.fp_estado = s.estado"""
APPLIED_LINES = """
    SELECT * FROM payment_line
        JOIN payment ON p_numero = dp_num_pago
        JOIN invoice ON fa_numero = dp_num_factura"""
ROWS = {
    "applied_line": APPLIED_LINES,
    "sliced_line": INVOICE_LINES,
    "sliced_form": FORMS,
    "sliced_ext_form": EXT_FORMS,
}

SLICE = "slice_id, slice_fecha, slice_empresa"


def _invoice_row(amount: str) -> str:
    return f"""
        SELECT {SLICE}, de_numero AS in_num_documento, 6 AS in_tipo_documento,
            '-' AS in_cod_forma_pago, pf_id_parametro AS in_param, {amount} AS in_valor,
            pf_cuenta AS in_cuenta, {RUN_TS} AS in_fecha_ing, de_fecha AS in_fecha_cont,
            de_estado AS in_estado, 'T' AS in_terminal, 'SA' AS in_operador,
            de_cotizacion AS in_cotizacion, 1 AS in_moneda,
            de_num_linea || '-' || de_descripcion AS in_descripcion_reg,
            de_num_linea AS in_linea, de_cod_empresa AS in_cod_empresa"""


def _mapped_invoice(param: int, amount: str, condition: str = "true") -> str:
    return f"""{_invoice_row(amount)}
        FROM sliced_line JOIN invoice_account_map ON pf_id_producto = de_item
        WHERE pf_id_parametro = {param} AND {condition}"""


INVOICE_BRANCHES = {
    "tax": _invoice_row("de_itbis * -1") + """
        FROM sliced_line LEFT JOIN
            (SELECT * FROM invoice_account_map WHERE pf_id_parametro = 15)
            ON pf_id_producto = de_item""",
    "receivable": _mapped_invoice(1, "de_total"),
    "direct_income": _mapped_invoice(3, "de_subtotal * -1", "de_descuento_sa = 0"),
    "insurer_income": _mapped_invoice(2, "de_subtotal * -1", "de_descuento_sa <> 0"),
    "insurer_receivable": _invoice_row("de_descuento_sa_bse") + """
        FROM sliced_line, invoice, work_order, invoice_account_map
        WHERE fa_numero = de_numero AND ot_codigo = fa_ord_tra AND pf_id_producto = de_item
            AND pf_id_parametro = 14 AND pf_aseguradora = ot_cia_seguros""",
    "insurer_premium": _mapped_invoice(13, "de_descuento_sa - de_descuento_sa_bse"),
    "discount": _mapped_invoice(
        12, "de_descuento_lj + de_monto_financiado", "de_descuento_sa = 0"
    ),
    "insurer_discount": _mapped_invoice(11, "de_descuento_lj", "de_descuento_sa <> 0"),
}


def _payment_row(**values: str) -> str:
    columns = {
        "in_fecha_ing": RUN_TS,
        "in_terminal": "'T'",
        "in_operador": "'SA'",
        **values,
    }
    return f"SELECT {SLICE}, " + ", ".join(f"{v} AS {n}" for n, v in columns.items())


def _form_row(param: str, amount: str, account: str, text: str) -> str:
    return _payment_row(
        in_num_documento="fp_num_pago", in_tipo_documento="0", in_cod_forma_pago="fp_forma_pago",
        in_param=param, in_valor=amount, in_cuenta=account, in_fecha_cont="fp_fecha",
        in_estado="fp_estado", in_cotizacion="fp_cotizacion", in_moneda="fp_moneda",
        in_fecha_facturaCXC="fp_fecha", in_linea="1", in_cod_empresa="empresa",
        in_descripcion_cta=text,
    )


def _rate(company_3: str, other: str) -> str:
    return f"(CASE WHEN slice_empresa = 3 THEN {company_3} ELSE {other} END)::DOUBLE"


def _mapped_form(
    form: str, param: int, amount: str, currency: str = "fp_moneda = 1",
    source: str = "sliced_form", account: str = "pp_cuenta",
) -> str:
    return f"""{_form_row(str(param), amount, account, "pp_descripcion_cta")}
        FROM {source} JOIN payment_account_map ON pp_id_empresa = empresa AND pp_id_param = {param}
        WHERE fp_forma_pago = '{form}' AND {currency}"""


def _card_income(source: str) -> str:
    row = _form_row(
        "bp_id", f"fp_valor - fp_valor * {_rate('0.055', '0.06')}", "bp_cuenta_contable",
        "cu_descripcion",
    )
    return f"""{row}
        FROM {source} JOIN bank_account_map ON bp_id = fp_id_banco_cuenta
            JOIN ledger_account ON cu_cuenta = bp_cuenta_contable AND cu_uni_neg = bp_uni_neg
        WHERE fp_forma_pago = 'TRJ' AND fp_moneda = 1"""


def _deposits(source: str) -> str:
    # A late deposit is one of another calendar month; a NULL date is not late.
    late = (
        "coalesce(fp_forma_pago = 'DPC' AND strftime(fp_fecha_deposito, '%Y%m')"
        " <> strftime(fp_fecha, '%Y%m'), false)"
    )
    row = _form_row(
        f"CASE WHEN {late} THEN 14 ELSE bp_id END", "fp_valor",
        f"CASE WHEN {late} THEN '2141005' ELSE bp_cuenta_contable END",
        f"CASE WHEN {late} THEN pp_descripcion_cta ELSE cu_descripcion END",
    )
    return f"""{row}
        FROM {source} JOIN bank_account_map ON bp_id = fp_id_banco_cuenta
            JOIN ledger_account ON cu_cuenta = bp_cuenta_contable AND cu_uni_neg = bp_uni_neg
            JOIN payment_account_map ON pp_cuenta = '2141005' AND pp_id_empresa = empresa
        WHERE fp_forma_pago IN ('DPC', 'CHQ') AND fp_moneda = 1"""


_CARD_TAX = f"fp_valor * {_rate('0.02', '0.02')}"
_CARD_COMMISSION = f"fp_valor * {_rate('0.035', '0.04')}"

PAYMENT_BRANCHES = {
    "receivable": _payment_row(
        in_num_documento="p_numero", in_tipo_documento="p_tipo_docum", in_cod_forma_pago="'-'",
        in_param="1", in_valor="dp_valor * -1", in_cuenta="pp_cuenta", in_fecha_cont="p_fecha",
        in_estado="p_estado", in_cotizacion="p_cotizacion", in_moneda="1",
        in_fecha_facturaCXC="fa_fecha", in_linea="dp_linea", in_cod_empresa="dp_cod_empresa",
        in_descripcion_cta="pp_descripcion_cta",
    ).replace(SLICE, "slice_id, s.fecha AS slice_fecha, s.empresa AS slice_empresa") + """
        FROM applied_line, slices s, payment_account_map
        WHERE dp_fecha_documento::DATE = s.fecha AND p_estado = s.estado
            AND p_cod_empresa = s.empresa AND fa_cod_empresa = s.empresa
            AND pp_id_param = 1 AND pp_id_empresa = s.empresa
            AND p_tipo_docum <> 4 AND p_tipo_docum <> 5 AND p_tipo_docum <> 6""",
    "card_tax": _mapped_form("TRJ", 2, _CARD_TAX, "true"),
    "card_commission": _mapped_form("TRJ", 3, _CARD_COMMISSION, "true"),
    "card_income": _card_income("sliced_form"),
    "deposit": _deposits("sliced_form"),
    "cash_local": _form_row("0", "fp_valor", "'1111005'", "'CTA CTE BANCO BHD'") + """
        FROM sliced_form WHERE fp_forma_pago = 'EFE' AND fp_moneda = 1""",
    "cash_foreign": _mapped_form(
        "EFE", 12, "fp_valor_bse", "fp_moneda = 2", account="'1112002'"
    ),
    "credit_note": _mapped_form("NC", 7, "fp_valor / 1.18::DOUBLE"),
    "credit_note_tax": _mapped_form("NC", 10, "(fp_valor / 1.18::DOUBLE) * 0.18::DOUBLE"),
    "advance_received": _payment_row(
        in_num_documento="p_numero", in_tipo_documento="p_tipo_docum", in_cod_forma_pago="'-'",
        in_param="8", in_valor="p_valor * -1", in_cuenta="pp_cuenta", in_fecha_cont="p_fecha",
        in_estado="p_estado", in_cotizacion="p_cotizacion", in_moneda="1",
        in_fecha_facturaCXC="p_fecha", in_linea="1", in_cod_empresa="p_cod_empresa",
        in_descripcion_cta="pp_descripcion_cta",
    ).replace(SLICE, "slice_id, s.fecha AS slice_fecha, s.empresa AS slice_empresa") + """
        FROM payment, payment_account_map, slices s
        WHERE p_tipo_docum = 4 AND p_fecha::DATE = s.fecha AND p_cod_empresa = s.empresa
            AND p_estado = s.estado AND pp_id_param = 8 AND pp_id_empresa = s.empresa""",
    "advance_applied": _mapped_form("CRC", 8, "fp_valor"),
    "withholding_30": _mapped_form("RTC", 9, "fp_valor"),
    "withholding_100": _mapped_form("RT1", 24, "fp_valor"),
    "withholding_5": _mapped_form("R5%", 13, "fp_valor"),
    "write_off": _mapped_form("CCA", 15, "fp_valor"),
    "ext_deposit": _deposits("sliced_ext_form"),
    "ext_card_tax": _mapped_form("TRJ", 2, _CARD_TAX, "true", "sliced_ext_form"),
    "ext_card_commission": _mapped_form("TRJ", 3, _CARD_COMMISSION, "true", "sliced_ext_form"),
    "ext_card_income": _card_income("sliced_ext_form"),
}

ROWS["invoice_row"] = " UNION ALL BY NAME ".join(INVOICE_BRANCHES.values())
ROWS["payment_row"] = " UNION ALL BY NAME ".join(PAYMENT_BRANCHES.values())
ROWS["posted_invoice"] = "SELECT * FROM invoice_row WHERE in_valor NOT IN (0)"
ROWS["purged"] = "SELECT p_numero, p_fecha::DATE AS p_dia FROM payment WHERE p_tipo_docum = 5"
# What each payment run leaves of its own rows.
ROWS["posted_payment"] = """
    SELECT * FROM payment_row r
    WHERE NOT EXISTS (FROM purged WHERE p_numero = r.in_num_documento AND p_dia = r.slice_fecha)
        AND NOT coalesce(in_valor = 0 AND in_cod_empresa = slice_empresa, false)"""
# The journal after all runs, in order: no later step deletes a remaining row.
ROWS["invoice_state"] = """
    SELECT * FROM (SELECT NULL AS slice_id, * FROM initial_journal UNION ALL BY NAME
        SELECT * EXCLUDE (slice_fecha, slice_empresa) FROM posted_invoice) r
    WHERE NOT coalesce(in_tipo_documento = 6 AND in_cod_empresa IN (
        SELECT empresa FROM slices s WHERE r.slice_id IS NULL OR s.slice_id > r.slice_id), false)"""
ROWS["payment_state"] = """
    SELECT * FROM (SELECT NULL AS slice_id, NULL AS slice_empresa, * FROM {before}
        UNION ALL BY NAME SELECT * EXCLUDE (slice_fecha) FROM payment_row) r
    WHERE NOT coalesce(in_tipo_documento <> 6 AND in_cod_empresa IN (
            SELECT empresa FROM slices s WHERE r.slice_id IS NULL OR s.slice_id > r.slice_id), false)
        AND NOT coalesce(in_tipo_documento <> 6 AND in_num_documento IN (
            SELECT p_numero FROM purged, slices s
            WHERE p_dia = s.fecha AND (r.slice_id IS NULL OR s.slice_id >= r.slice_id)), false)
        AND NOT coalesce(in_tipo_documento <> 6 AND in_valor = 0
            AND in_cod_empresa = slice_empresa, false)"""

# -- reversals ----------------------------------------------------------------------


# Calls of the replay: one per reversal date and company.
REVERSAL_CALLS = """
    SELECT row_number() OVER (ORDER BY d.fecha, e.empresa) AS slice_id, d.fecha::DATE AS fecha,
        e.empresa, 'R' AS estado
    FROM generate_series(DATE '2024-02-01', DATE '2024-02-10', INTERVAL 1 DAY) d(fecha)
    CROSS JOIN (VALUES (1), (2), (3)) e(empresa)"""

REVERSALS = {
    "payments": """
        SELECT s.slice_id AS llamada, rp_num_pago AS num_doc, p_fecha::DATE AS fecha_contable,
            rp_cod_empresa::INTEGER AS empresa, rp_user AS usuario
        FROM payment_reversal JOIN payment ON p_numero = rp_num_pago
            JOIN slices s ON rp_fecha::DATE = s.fecha AND rp_cod_empresa = s.empresa""",
    "invoices": """
        SELECT s.slice_id AS llamada, rv_num_factura AS num_doc, fa_fecha::DATE AS fecha_contable,
            rv_cod_empresa::INTEGER AS empresa, rv_user AS usuario
        FROM invoice_reversal JOIN invoice ON fa_numero = rv_num_factura
            JOIN slices s ON rv_fecha::DATE = s.fecha AND rv_cod_empresa = s.empresa""",
    "ext_payments": """
        SELECT s.slice_id AS llamada, rp_num_pago AS num_doc, p_fecha::DATE AS fecha_contable,
            1 AS empresa, rp_user AS usuario
        FROM ext_payment_reversal JOIN ext_payment ON p_numero = rp_num_pago
            JOIN slices s ON rp_fecha::DATE = s.fecha AND s.empresa = 1""",
}
ROWS["reversed_document"] = " UNION ALL ".join(REVERSALS.values())
ROWS["reversal_date"] = """
    SELECT llamada, empresa, fecha,
        (row_number() OVER (PARTITION BY llamada ORDER BY fecha NULLS FIRST))::INTEGER AS id
    FROM (SELECT DISTINCT llamada, empresa, fecha_contable AS fecha FROM reversed_document)"""
REPLAY = """
    SELECT ((llamada - 1) * 10000000 + id)::BIGINT AS slice_id, fecha, 1 AS empresa,
        'R' AS estado
    FROM replayed_date"""


def calls(slices: str) -> dict[str, str]:
    """The calls of a replay, apart from the slices it posts."""
    found = " UNION ALL ".join(REVERSALS.values()).replace("JOIN slices s", "JOIN calls s")
    dates = ROWS["reversal_date"].replace("reversed_document", "replayed_document")
    return {"calls": slices, "replayed_document": found, "replayed_date": dates}


# -- statements ---------------------------------------------------------------------


@cache
def _needs(text: str) -> frozenset[str]:
    return frozenset(re.findall(r"\b[a-z_]+\b", text))


def statement(
    body: str,
    slices: str | None = None,
    extra: dict[str, str] | None = None,
    tables: dict[str, str] = TABLES,
) -> str:
    """``body`` with the common table expressions it needs, in order of use."""
    known = {**tables, **ROWS, **(extra or {})}
    if slices is not None:
        known["slices"] = slices
    ordered: dict[str, str] = {}

    def add(text: str) -> None:
        for name in known:
            if name in _needs(text) and name not in ordered:
                add(known[name])
                ordered[name] = known[name]

    add(body)
    if not ordered:
        return body
    # Materialised where the order of joins must not be left to estimates.
    fixed = {"applied_line": "AS MATERIALIZED", "slices": "AS MATERIALIZED"}
    parts = ",\n".join(f"{n} {fixed.get(n, 'AS')} ({sql})" for n, sql in ordered.items())
    return f"WITH {parts}\n{body}"


WITHOUT_SLICE = "SELECT * EXCLUDE (slice_id, slice_fecha, slice_empresa)"


def branch(sql: str, slices: str) -> str:
    return statement(f"{WITHOUT_SLICE} FROM ({sql})", slices)


def lookup() -> str:
    listed = ", ".join(f"'{account}'" for account in LOOKUP_ACCOUNTS)
    return statement(
        f"SELECT * FROM ledger_account WHERE cu_cuenta IN ({listed}) AND cu_uni_neg = '{LOOKUP_UNIT}'"
    )


def seeded(company: int) -> str:
    return statement(
        f"SELECT * FROM supplier_accounts UNION ALL {_map_values(_seed_values(company))}"
    )
