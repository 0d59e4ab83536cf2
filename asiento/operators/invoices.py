"""Journal rows of invoice lines.

Seven of the eight branches look an account up by product. They share one scan of the
lines and one join: each mapped parameter of the product gives one row. The insurer's
receivable looks its account up by product and insurer and has a scan of its own.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asiento.context import RunContext
from asiento.functions.amounts import choose, credit, money
from asiento.plans.rules import (
    INSURER_BRANCH,
    INVOICE_BRANCHES,
    INVOICE_DOCUMENT,
    INVOICE_RULES,
    LOCAL_CURRENCY,
    NO_FORM,
    UNMAPPED_BRANCH,
    InvoiceRule,
)
from asiento.slices import ROW_COLUMNS, SliceSet
from asiento.sources.schemas import INVOICE_ROW
from asiento.sources.shared import unsized, write_shared
from asiento.sources.tables import Tables

# Document numbers that may pass through the driver: some 85 bytes each in a broadcast, 5 in a file.
BROADCAST_NAMES = 200_000


def invoice_rows(
    tables: Tables,
    slices: SliceSet,
    ctx: RunContext,
    branches: Iterable[str] = INVOICE_BRANCHES,
) -> DataFrame:
    """Rows of the given branches for every slice, zero and NULL amounts included."""
    wanted = set(branches)
    if unknown := wanted - set(INVOICE_BRANCHES):
        raise ValueError(f"unknown invoice branches: {sorted(unknown)}")
    by_product = [r for r in INVOICE_RULES if r.branch in wanted and r.branch != INSURER_BRANCH]
    parts = []
    if by_product:
        parts.append(_rows_by_product(tables, slices, ctx, by_product))
    if INSURER_BRANCH in wanted:
        parts.append(_insurer_rows(tables, slices, ctx))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def post_invoices(
    tables: Tables,
    slices: SliceSet,
    ctx: RunContext,
    branches: Iterable[str] = INVOICE_BRANCHES,
) -> DataFrame:
    """The rows an invoice run posts: amounts of zero and NULL amounts are left out."""
    return invoice_rows(tables, slices, ctx, branches).filter(F.col("in_valor") != 0)


def _lines(tables: Tables, slices: SliceSet, ctx: RunContext) -> DataFrame:
    return slices.select_from(tables.invoice_line, ctx, "de_fecha", "de_cod_empresa", "de_estado")


def _rows_by_product(
    tables: Tables, slices: SliceSet, ctx: RunContext, rules: list[InvoiceRule]
) -> DataFrame:
    accounts = tables.invoice_account_map.select(
        "pf_id_producto", "pf_id_parametro", "pf_cuenta"
    ).filter(F.col("pf_id_parametro").isin([rule.param for rule in rules]))
    unmapped = next((rule for rule in rules if rule.branch == UNMAPPED_BRANCH), None)
    if unmapped is not None and len(rules) > 1:
        accounts = accounts.unionByName(_missing_rows(accounts, unmapped.param))
    posted = _lines(tables, slices, ctx).join(
        unsized(accounts),
        F.col("de_item") == F.col("pf_id_producto"),
        "left" if unmapped is not None else "inner",
    )

    param = F.col("pf_id_parametro")
    if unmapped is not None:
        # Without a map row the line still posts, with neither parameter nor account.
        param = F.coalesce(param, F.lit(unmapped.param))
    no_insurer = F.col("de_descuento_sa") == 0
    applies = {
        "all": F.lit(True),
        "without_insurer": no_insurer,
        "with_insurer": F.col("de_descuento_sa") != 0,
    }
    kept = F.lit(False)
    for lines, condition in applies.items():
        params = [rule.param for rule in rules if rule.lines == lines]
        if params:
            kept = kept | (param.isin(params) & condition)
    amounts = {rule.param: _amount(rule.amount) for rule in rules}
    return _to_journal(posted.filter(kept), choose(param, amounts), ctx)


def _missing_rows(accounts: DataFrame, param: int) -> DataFrame:
    """A row without parameter and account for each mapped product that lacks ``param``.

    A left join alone would only cover products that are not in the map at all.
    """
    by_product = accounts.groupBy("pf_id_producto").agg(
        F.max(F.col("pf_id_parametro") == param).alias("mapped")
    )
    schema = accounts.schema
    return by_product.filter(~F.col("mapped")).select(
        "pf_id_producto",
        F.lit(None).cast(schema["pf_id_parametro"].dataType).alias("pf_id_parametro"),
        F.lit(None).cast(schema["pf_cuenta"].dataType).alias("pf_cuenta"),
    )


def _insurer_rows(tables: Tables, slices: SliceSet, ctx: RunContext) -> DataFrame:
    rule = next(r for r in INVOICE_RULES if r.branch == INSURER_BRANCH)
    lines = _lines(tables, slices, ctx)
    invoices = tables.invoice.select("fa_numero", "fa_ord_tra")
    orders = tables.work_order.select("ot_codigo", "ot_cia_seguros")
    accounts = (
        tables.invoice_account_map.filter(F.col("pf_id_parametro") == rule.param)
        .select("pf_id_producto", "pf_aseguradora", "pf_id_parametro", "pf_cuenta")
    )
    of_invoice = F.col("de_numero") == F.col("fa_numero")
    of_order = F.col("fa_ord_tra") == F.col("ot_codigo")
    if ctx.keys_first:
        lines = write_shared(lines, "lines")
        invoices = _asked_for(invoices, "fa_numero", lines, "de_numero")
        invoiced = write_shared(lines.join(unsized(invoices), of_invoice), "invoiced")
        orders = _asked_for(orders, "ot_codigo", invoiced, "fa_ord_tra")
    else:
        # The lines shrink the invoices before these meet the work orders.
        invoiced = lines.join(unsized(invoices), of_invoice)
    insured = invoiced.join(unsized(orders), of_order)
    posted = insured.join(
        unsized(accounts),
        (F.col("de_item") == F.col("pf_id_producto"))
        & (F.col("ot_cia_seguros") == F.col("pf_aseguradora")),
    )
    return _to_journal(posted, _amount(rule.amount), ctx)


def _asked_for(table: DataFrame, key: str, asking: DataFrame, by: str) -> DataFrame:
    """The rows of ``table`` that ``asking`` names.

    The names are written first and counted. Spark broadcasts few of them, so that other rows of
    ``table`` are dropped where they are read; many are sorted, however small their files.
    """
    asked = write_shared(asking.select(F.col(by).alias("asked")).distinct(), "asked")
    if asked.count() > BROADCAST_NAMES:
        asked = unsized(asked)
    return table.join(asked, F.col(key) == F.col("asked"), "left_semi")


def _amount(name: str) -> Column:
    return {
        "tax": credit(money("de_itbis")),
        "total": money("de_total"),
        "income": credit(money("de_subtotal")),
        "insurer_share": money("de_descuento_sa_bse"),
        "premium": money("de_descuento_sa") - money("de_descuento_sa_bse"),
        "discount_and_financed": money("de_descuento_lj") + money("de_monto_financiado"),
        "discount": money("de_descuento_lj"),
    }[name]


def _to_journal(posted: DataFrame, amount: Column, ctx: RunContext) -> DataFrame:
    """Journal columns of an invoice run, and the slice each row belongs to."""
    # concat, unlike concat_ws, gives NULL for a line without text.
    text = F.concat(F.col("de_num_linea").cast("string"), F.lit("-"), F.col("de_descripcion"))
    values = {
        "in_num_documento": F.col("de_numero"),
        "in_tipo_documento": F.lit(INVOICE_DOCUMENT),
        "in_cod_forma_pago": F.lit(NO_FORM),
        "in_param": F.col("pf_id_parametro"),
        "in_valor": amount,
        "in_cuenta": F.col("pf_cuenta"),
        "in_fecha_ing": ctx.ingestion_time(),
        "in_fecha_cont": F.col("de_fecha"),
        "in_estado": F.col("de_estado"),
        "in_terminal": F.lit(ctx.terminal),
        "in_operador": F.lit(ctx.user),
        "in_cotizacion": F.col("de_cotizacion"),
        "in_moneda": F.lit(LOCAL_CURRENCY),
        "in_descripcion_reg": text,
        "in_linea": F.col("de_num_linea"),
        "in_cod_empresa": F.col("de_cod_empresa"),
    }
    return posted.select(*ROW_COLUMNS, *(values[name].alias(name) for name in INVOICE_ROW))
