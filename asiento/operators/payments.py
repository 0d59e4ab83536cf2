"""Journal rows of payments, payment lines and payment forms.

The forms of both systems share one pass: the account map unfolds into a small guide,
keyed by system, company and form, with one row per posting; a single join with the guide
turns each form into its postings.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asiento.context import RunContext
from asiento.functions.amounts import choose, credit, form_amounts, money
from asiento.functions.predicates import definitely, late_deposit
from asiento.plans.rules import (
    ADVANCE_DOCUMENT,
    ADVANCE_PARAM,
    EXT_COMPANY,
    EXT_FORM_RULES,
    EXT_PREFIX,
    FORM_DOCUMENT,
    FORM_RULES,
    LATE_PARAM,
    LOCAL_CURRENCY,
    NO_FORM,
    NOT_RECEIVABLE_DOCUMENTS,
    PAYMENT_BRANCHES,
    RECEIVABLE_BRANCH,
    RECEIVABLE_PARAM,
    FormRule,
)
from asiento.slices import ROW_COLUMNS, SliceSet
from asiento.sources.schemas import PAYMENT_ROW
from asiento.sources.shared import unsized
from asiento.sources.tables import Tables

OWN, EXT = "own", "ext"


def payment_rows(
    tables: Tables,
    slices: SliceSet,
    ctx: RunContext,
    branches: Iterable[str] = PAYMENT_BRANCHES,
) -> DataFrame:
    """Rows of the given branches for every slice, before the purges of the run."""
    wanted = set(branches)
    if unknown := wanted - set(PAYMENT_BRANCHES):
        raise ValueError(f"unknown payment branches: {sorted(unknown)}")
    rules = {
        OWN: [r for r in FORM_RULES if r.branch in wanted],
        EXT: [r for r in EXT_FORM_RULES if EXT_PREFIX + r.branch in wanted],
    }
    parts = []
    if RECEIVABLE_BRANCH in wanted:
        parts.append(_receivable_rows(tables, slices, ctx))
    if "advance_received" in wanted:
        parts.append(_advance_rows(tables, slices, ctx))
    if rules[OWN] or rules[EXT]:
        parts.append(_form_rows(tables, slices, ctx, rules))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return _as_stored(rows, ctx)


def _as_stored(rows: DataFrame, ctx: RunContext) -> DataFrame:
    """The journal's own type of amounts, so that the purge of zeros sees what is stored."""
    if ctx.sink_decimal is None:
        return rows
    precision, scale = ctx.sink_decimal
    return rows.withColumn("in_valor", F.col("in_valor").cast(f"decimal({precision},{scale})"))


def settled_lines(tables: Tables, slices: SliceSet, ctx: RunContext, purged: DataFrame) -> DataFrame:
    """Rows of payment lines, less those whose document a run of the line's date purges.

    ``purged`` holds ``purged, purged_on``, each once.
    """
    def purge(applied: DataFrame) -> DataFrame:
        of_day = (F.col("p_numero") == F.col("purged")) & (F.to_date("dp_fecha_documento") == F.col("purged_on"))
        return applied.join(purged, of_day, "left_anti")

    return _as_stored(_receivable_rows(tables, slices, ctx, purge), ctx)


def unpurged_lines(tables: Tables, slices: SliceSet, ctx: RunContext, purged: DataFrame) -> DataFrame:
    """Rows of payment lines, less those whose document their own run or a later one purges.

    ``purged`` holds ``purged, last_run``, each document once.
    """
    def mark(applied: DataFrame) -> DataFrame:
        return applied.join(purged, F.col("p_numero") == F.col("purged"), "left")

    rows = _receivable_rows(tables, slices, ctx, mark, later=F.col("last_run") >= F.col("slice_id"))
    return _as_stored(rows, ctx)


# -- payments and payment lines ---------------------------------------------------


def _company_account(tables: Tables, param: int) -> DataFrame:
    return tables.payment_account_map.filter(F.col("pp_id_param") == param).select(
        "pp_id_empresa", "pp_cuenta", "pp_descripcion_cta"
    )


def _receivable_rows(
    tables: Tables,
    slices: SliceSet,
    ctx: RunContext,
    purge: Callable[[DataFrame], DataFrame] | None = None,
    later: Column | None = None,
) -> DataFrame:
    """Payments applied to invoices. Only payment and invoice must be of the slice's company.

    A line lies in as many slices as there are calls that replay its date. It takes its slices last, so
    that it is moved and sorted once; what of a purge needs no slice (``purge``) comes before,
    and the slices of a line that are purged ``later`` go as it takes them.
    """
    lines = slices.narrow(tables.payment_line, ctx, fecha="dp_fecha_documento")
    payments = slices.narrow(
        tables.payment.filter(~F.col("p_tipo_docum").isin(*NOT_RECEIVABLE_DOCUMENTS)),
        ctx,
        empresa="p_cod_empresa",
        estado="p_estado",
    )
    applied = lines.join(unsized(payments), F.col("dp_num_pago") == F.col("p_numero"))
    if purge is not None:
        applied = purge(applied)
    invoices = slices.narrow(tables.invoice, ctx, empresa="fa_cod_empresa").select(
        "fa_numero", "fa_cod_empresa", "fa_fecha"
    )
    posted = applied.join(
        unsized(invoices),
        (F.col("dp_num_factura") == F.col("fa_numero"))
        & (F.col("p_cod_empresa") == F.col("fa_cod_empresa")),
    ).join(
        _company_account(tables, RECEIVABLE_PARAM),
        F.col("fa_cod_empresa") == F.col("pp_id_empresa"),
    )
    posted = slices.select_from(posted, ctx, "dp_fecha_documento", "p_cod_empresa", "p_estado")
    if later is not None:
        posted = posted.filter(~definitely(later))
    return _to_journal(
        posted,
        ctx,
        in_num_documento=F.col("p_numero"),
        in_tipo_documento=F.col("p_tipo_docum"),
        in_cod_forma_pago=F.lit(NO_FORM),
        in_param=F.lit(RECEIVABLE_PARAM),
        in_valor=credit(money("dp_valor")),
        in_cuenta=F.col("pp_cuenta"),
        in_fecha_cont=F.col("p_fecha"),
        in_estado=F.col("p_estado"),
        in_cotizacion=F.col("p_cotizacion"),
        in_moneda=F.lit(LOCAL_CURRENCY),
        in_fecha_facturaCXC=F.col("fa_fecha"),
        in_linea=F.col("dp_linea"),
        in_cod_empresa=F.col("dp_cod_empresa"),
        in_descripcion_cta=F.col("pp_descripcion_cta"),
    )


def _advance_rows(tables: Tables, slices: SliceSet, ctx: RunContext) -> DataFrame:
    """Advances received: payments of one document type."""
    advances = tables.payment.filter(F.col("p_tipo_docum") == ADVANCE_DOCUMENT)
    posted = slices.select_from(advances, ctx, "p_fecha", "p_cod_empresa", "p_estado").join(
        _company_account(tables, ADVANCE_PARAM),
        F.col("p_cod_empresa") == F.col("pp_id_empresa"),
    )
    return _to_journal(
        posted,
        ctx,
        in_num_documento=F.col("p_numero"),
        in_tipo_documento=F.col("p_tipo_docum"),
        in_cod_forma_pago=F.lit(NO_FORM),
        in_param=F.lit(ADVANCE_PARAM),
        in_valor=credit(money("p_valor")),
        in_cuenta=F.col("pp_cuenta"),
        in_fecha_cont=F.col("p_fecha"),
        in_estado=F.col("p_estado"),
        in_cotizacion=F.col("p_cotizacion"),
        in_moneda=F.lit(LOCAL_CURRENCY),
        in_fecha_facturaCXC=F.col("p_fecha"),
        in_linea=F.lit(1),
        in_cod_empresa=F.col("p_cod_empresa"),
        in_descripcion_cta=F.col("pp_descripcion_cta"),
    )


# -- payment forms ------------------------------------------------------------------


def _form_rows(
    tables: Tables, slices: SliceSet, ctx: RunContext, rules: dict[str, list[FormRule]]
) -> DataFrame:
    forms = _forms(tables, slices, ctx, rules)
    guide = posting_guide(tables.payment_account_map, slices, ctx, rules)
    posted = forms.join(
        guide,
        (F.col("sistema") == F.col("g_sistema"))
        & (F.col("empresa") == F.col("g_empresa"))
        & (ctx.text(F.col("fp_forma_pago")) == ctx.text(F.col("g_form")))
        & (F.col("g_currency").isNull() | (F.col("fp_moneda") == F.col("g_currency"))),
    )
    account, text = F.col("g_account"), F.col("g_text")
    param = F.col("g_param")
    if any(rule.bank for system in rules.values() for rule in system):
        posted = _with_bank_account(posted, tables, ctx)
        late = F.col("g_late") & late_deposit(
            F.col("fp_forma_pago"), F.col("fp_fecha_deposito"), F.col("fp_fecha"), ctx
        )
        from_bank = F.col("g_bank")
        param = (
            F.when(from_bank & late, F.lit(LATE_PARAM))
            .when(from_bank, F.col("bp_id"))
            .otherwise(param)
        )
        account = (
            F.when(from_bank & late, account)
            .when(from_bank, F.col("bp_cuenta_contable"))
            .otherwise(account)
        )
        text = (
            F.when(from_bank & late, text)
            .when(from_bank, F.col("cu_descripcion"))
            .otherwise(text)
        )
    amounts = form_amounts(
        money("fp_valor"), money("fp_valor_bse"), F.col("slice_empresa"), ctx
    )
    used = {rule.amount for system in rules.values() for rule in system}
    return _to_journal(
        posted,
        ctx,
        in_num_documento=F.col("fp_num_pago"),
        in_tipo_documento=F.lit(FORM_DOCUMENT),
        in_cod_forma_pago=F.col("fp_forma_pago"),
        in_param=param,
        in_valor=choose(F.col("g_amount"), {n: a for n, a in amounts.items() if n in used}),
        in_cuenta=account,
        in_fecha_cont=F.col("fp_fecha"),
        in_estado=F.col("fp_estado"),
        in_cotizacion=F.col("fp_cotizacion"),
        in_moneda=F.col("fp_moneda"),
        in_fecha_facturaCXC=F.col("fp_fecha"),
        in_linea=F.lit(1),
        in_cod_empresa=F.col("empresa"),
        in_descripcion_cta=text,
    )


def _forms(
    tables: Tables, slices: SliceSet, ctx: RunContext, rules: dict[str, list[FormRule]]
) -> DataFrame:
    """Forms of both systems that some rule posts, one row for each slice they lie in."""
    parts = []
    if rules[OWN]:
        own = slices.select_from(
            tables.payment_form.filter(_has_rule(rules[OWN], ctx)),
            ctx,
            "fp_fecha",
            "fp_cod_empresa",
            "fp_estado",
        )
        parts.append(own.withColumns({"sistema": F.lit(OWN), "empresa": F.col("fp_cod_empresa")}))
    if rules[EXT]:
        # The second system has no company: every slice of the date and state takes its
        # forms, books them as one fixed company and applies its own card rates.
        runs = slices
        if ctx.ext_only_for_company is not None:
            runs = slices.for_company(ctx.ext_only_for_company)
        ext = runs.select_from(
            tables.ext_payment_form.filter(_has_rule(rules[EXT], ctx)),
            ctx,
            "fp_fecha",
            estado="fp_estado",
        )
        parts.append(
            ext.withColumns(
                {
                    "sistema": F.lit(EXT),
                    "empresa": F.lit(EXT_COMPANY),
                    "fp_valor_bse": F.lit(None).cast("double"),
                }
            )
        )
    columns = [
        *ROW_COLUMNS, "sistema", "empresa", "fp_num_pago", "fp_forma_pago",
        "fp_moneda", "fp_valor", "fp_valor_bse", "fp_fecha", "fp_fecha_deposito", "fp_estado",
        "fp_cotizacion", "fp_id_banco_cuenta",
    ]
    forms = parts[0].select(*columns)
    for part in parts[1:]:
        forms = forms.unionByName(part.select(*columns))
    return forms


def _has_rule(rules: list[FormRule], ctx: RunContext) -> Column:
    """The form has a rule for its currency: checked at the scan, before any join."""
    form = ctx.text(F.col("fp_forma_pago"))
    currencies: dict[int | None, set[str]] = {}
    for rule in rules:
        currencies.setdefault(rule.currency, set()).add(rule.form)
    found = F.lit(False)
    for currency, codes in currencies.items():
        of_form = F.lit(False)
        if ctx.collation is None:
            of_form = form.isin(sorted(codes))
        else:
            for code in sorted(codes):
                of_form = of_form | (form == code)
        found = found | (
            of_form if currency is None else of_form & (F.col("fp_moneda") == currency)
        )
    return found


def posting_guide(
    account_map: DataFrame, slices: SliceSet, ctx: RunContext, rules: dict[str, list[FormRule]]
) -> DataFrame:
    """One row per system, company, form and posting.

    Each map row unfolds into the rules it serves, so a duplicated map row doubles the
    postings and an absent one drops them. Rules without a map row hold for every company
    of the slices.
    """
    from_map = [(s, r) for s, rs in rules.items() for r in rs if r.requires_map]
    free = [(s, r) for s, rs in rules.items() for r in rs if not r.requires_map]
    parts = []
    if from_map:
        serves = F.filter(
            _rule_array(from_map),
            lambda r: F.when(
                r["late"], ctx.text(F.col("pp_cuenta")) == ctx.text(r["account"])
            ).otherwise(F.col("pp_id_param") == r["param"]),
        )
        parts.append(
            account_map.select(
                F.col("pp_id_empresa").alias("g_empresa"),
                "pp_cuenta",
                "pp_descripcion_cta",
                F.explode(serves).alias("rule"),
            ).withColumns(
                {
                    "g_account": F.coalesce(F.col("rule.account"), F.col("pp_cuenta")),
                    "g_text": F.col("pp_descripcion_cta"),
                }
            )
        )
    for system in (OWN, EXT):
        of_system = [(s, rule) for s, rule in free if s == system]
        if not of_system:
            continue
        companies = slices.companies()
        if system == EXT:
            companies = companies.select(F.lit(EXT_COMPANY).alias("empresa")).distinct()
        parts.append(
            companies.select(
                F.col("empresa").alias("g_empresa"),
                F.explode(_rule_array(of_system)).alias("rule"),
            ).withColumns({"g_account": F.col("rule.account"), "g_text": F.col("rule.text")})
        )
    columns = ["g_empresa", "g_account", "g_text"]
    names = {"system": "g_sistema", "form": "g_form", "currency": "g_currency",
             "amount": "g_amount", "param": "g_param", "bank": "g_bank", "late": "g_late"}
    unfolded = [F.col(f"rule.{name}").alias(alias) for name, alias in names.items()]
    guide = parts[0].select(*columns, *unfolded)
    for part in parts[1:]:
        guide = guide.unionByName(part.select(*columns, *unfolded))
    return guide


def _rule_array(rules: list[tuple[str, FormRule]]) -> Column:
    """The rules as one literal array of structs."""

    def struct(system: str, rule: FormRule) -> str:
        values = {
            "system": _sql_text(system),
            "form": _sql_text(rule.form),
            "currency": f"cast({_sql_number(rule.currency)} as int)",
            "amount": _sql_text(rule.amount),
            "param": f"cast({_sql_number(rule.param)} as int)",
            "account": f"cast({_sql_text(rule.late_account or rule.account)} as string)",
            "text": f"cast({_sql_text(rule.text)} as string)",
            "bank": str(rule.bank).lower(),
            "late": str(rule.late_account is not None).lower(),
        }
        return "named_struct(" + ", ".join(f"'{n}', {v}" for n, v in values.items()) + ")"

    return F.expr("array(" + ", ".join(struct(system, rule) for system, rule in rules) + ")")


def _sql_text(value: str | None) -> str:
    return "null" if value is None else "'" + value.replace("'", "\\'") + "'"


def _sql_number(value: int | None) -> str:
    return "null" if value is None else str(value)


def _with_bank_account(posted: DataFrame, tables: Tables, ctx: RunContext) -> DataFrame:
    """Bank account and ledger text of the postings that need them.

    Such a posting needs both rows; the other postings pass through.
    """
    needed = F.when(F.col("g_bank"), F.col("fp_id_banco_cuenta"))
    ledger = tables.ledger_account.select("cu_cuenta", "cu_uni_neg", "cu_descripcion")
    # Two small tables meet first, so that the postings move once.
    banks = (
        tables.bank_account_map.select("bp_id", "bp_cuenta_contable", "bp_uni_neg")
        .join(
            ledger,
            (ctx.text(F.col("bp_cuenta_contable")) == ctx.text(F.col("cu_cuenta")))
            & (ctx.text(F.col("bp_uni_neg")) == ctx.text(F.col("cu_uni_neg"))),
        )
        .select("bp_id", "bp_cuenta_contable", "cu_descripcion")
    )
    found = posted.join(banks, needed == F.col("bp_id"), "left")
    return found.filter(~F.col("g_bank") | F.col("bp_id").isNotNull())


# -- journal columns ----------------------------------------------------------------


def _to_journal(posted: DataFrame, ctx: RunContext, **values: Column) -> DataFrame:
    """Journal columns of a payment run, and the slice each row belongs to."""
    values |= {
        "in_fecha_ing": ctx.ingestion_time(),
        "in_terminal": F.lit(ctx.terminal),
        "in_operador": F.lit(ctx.user),
    }
    return posted.select(*ROW_COLUMNS, *(values[name].alias(name) for name in PAYMENT_ROW))
