"""Columns of the input tables and of the journal.

Keys may come as int or bigint and money as double or decimal: a table fits a schema when
each column has the right kind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

KEY, MONEY, TEXT, TIME = T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


INVOICE_LINE = _schema(
    de_numero=KEY, de_num_linea=KEY, de_item=KEY, de_cod_empresa=KEY, de_fecha=TIME,
    de_estado=TEXT, de_itbis=MONEY, de_total=MONEY, de_subtotal=MONEY,
    de_descuento_sa=MONEY, de_descuento_sa_bse=MONEY, de_descuento_lj=MONEY,
    de_monto_financiado=MONEY, de_cotizacion=MONEY, de_descripcion=TEXT,
)
INVOICE = _schema(fa_numero=KEY, fa_ord_tra=KEY, fa_fecha=TIME, fa_cod_empresa=KEY)
WORK_ORDER = _schema(ot_codigo=KEY, ot_cia_seguros=KEY)
INVOICE_ACCOUNT_MAP = _schema(
    pf_id_producto=KEY, pf_id_parametro=KEY, pf_cuenta=TEXT, pf_aseguradora=KEY
)
PAYMENT = _schema(
    p_numero=KEY, p_tipo_docum=KEY, p_fecha=TIME, p_estado=TEXT, p_cotizacion=MONEY,
    p_cod_empresa=KEY, p_valor=MONEY,
)
PAYMENT_LINE = _schema(
    dp_num_pago=KEY, dp_num_factura=KEY, dp_linea=KEY, dp_valor=MONEY,
    dp_fecha_documento=TIME, dp_cod_empresa=KEY,
)
EXT_PAYMENT_FORM = _schema(
    fp_num_pago=KEY, fp_forma_pago=TEXT, fp_valor=MONEY, fp_fecha=TIME,
    fp_fecha_deposito=TIME, fp_estado=TEXT, fp_cotizacion=MONEY, fp_moneda=KEY,
    fp_id_banco_cuenta=KEY,
)
PAYMENT_FORM = T.StructType(
    [*EXT_PAYMENT_FORM, T.StructField("fp_valor_bse", MONEY), T.StructField("fp_cod_empresa", KEY)]
)
EXT_PAYMENT = _schema(p_numero=KEY, p_fecha=TIME)
PAYMENT_ACCOUNT_MAP = _schema(
    pp_cuenta=TEXT, pp_descripcion_cta=TEXT, pp_fecha=TIME, pp_id_empresa=KEY, pp_id_param=KEY
)
BANK_ACCOUNT_MAP = _schema(bp_id=KEY, bp_cuenta_contable=TEXT, bp_uni_neg=TEXT)
LEDGER_ACCOUNT = _schema(cu_cuenta=TEXT, cu_uni_neg=TEXT, cu_descripcion=TEXT)
PAYMENT_REVERSAL = _schema(rp_num_pago=KEY, rp_cod_empresa=KEY, rp_user=TEXT, rp_fecha=TIME)
INVOICE_REVERSAL = _schema(rv_num_factura=KEY, rv_cod_empresa=KEY, rv_user=TEXT, rv_fecha=TIME)
EXT_PAYMENT_REVERSAL = _schema(rp_num_pago=KEY, rp_user=TEXT, rp_fecha=TIME)

JOURNAL = _schema(
    in_num_documento=T.LongType(), in_tipo_documento=KEY, in_cod_forma_pago=TEXT, in_param=KEY,
    in_valor=MONEY, in_cuenta=TEXT, in_fecha_ing=TIME, in_fecha_cont=TIME, in_estado=TEXT,
    in_terminal=TEXT, in_operador=TEXT, in_cotizacion=MONEY, in_moneda=KEY,
    in_descripcion_reg=TEXT, in_linea=KEY, in_cod_empresa=T.LongType(),
    in_fecha_facturaCXC=TIME, in_descripcion_cta=TEXT,
)

# Columns each posting sets; the journal leaves the others NULL.
INVOICE_ROW = [
    name for name in JOURNAL.names if name not in ("in_fecha_facturaCXC", "in_descripcion_cta")
]
PAYMENT_ROW = [name for name in JOURNAL.names if name != "in_descripcion_reg"]

_KINDS = {
    KEY: (T.IntegralType, T.DecimalType),
    MONEY: (T.NumericType,),
    TEXT: (T.StringType,),
    TIME: (T.TimestampNTZType, T.TimestampType, T.DateType),
}


def check_columns(df: DataFrame, schema: T.StructType, table: str) -> DataFrame:
    """``df`` itself, or an error naming every column that is absent or of another kind."""
    found = {field.name: field.dataType for field in df.schema}
    wrong = []
    for wanted in schema:
        kind = found.get(wanted.name)
        if kind is None:
            wrong.append(f"{wanted.name} is missing")
        elif not isinstance(kind, _KINDS[wanted.dataType]):
            wrong.append(
                f"{wanted.name} is {kind.simpleString()}, not {wanted.dataType.simpleString()}"
            )
    if wrong:
        raise ValueError(f"table {table}: " + "; ".join(wrong))
    return df
