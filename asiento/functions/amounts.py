"""Amount formulas. Money is double; the order of operations is part of the result."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from asiento.context import RunContext

# Sales tax 18 %, and the divisor that takes it out of a gross amount.
SALES_TAX = 0.18
GROSS_DIVISOR = 1.18


def money(name: str) -> Column:
    return F.col(name).cast("double")


def credit(amount: Column) -> Column:
    """Positive is debit, negative is credit."""
    return amount * -1


def card_net(gross: Column, rate: Column) -> Column:
    return gross - gross * rate


def form_amounts(
    value: Column, base_value: Column, company: Column, ctx: RunContext
) -> dict[str, Column]:
    """Every amount a payment form can post, by the name the rules use."""
    before_tax = value / GROSS_DIVISOR
    return {
        "value": value,
        "base_value": base_value,
        "card_tax": value * ctx.card_rate("tax", company),
        "card_commission": value * ctx.card_rate("commission", company),
        "card_net": card_net(value, ctx.card_rate("total", company)),
        "before_tax": before_tax,
        "tax_part": before_tax * SALES_TAX,
    }


def choose(selector: Column, options: dict[str | int, Column]) -> Column:
    """The option that ``selector`` names."""
    (first, column), *others = options.items()
    chosen = F.when(selector == first, column)
    for name, column in others:
        chosen = chosen.when(selector == name, column)
    return chosen
