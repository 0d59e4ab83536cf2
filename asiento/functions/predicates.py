"""Predicates with the journal's NULL rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from asiento.context import RunContext


def definitely(predicate: Column) -> Column:
    """TRUE only where ``predicate`` is TRUE; NULL counts as FALSE, as in a DELETE."""
    return F.coalesce(predicate, F.lit(False))


def late_deposit(form: Column, deposited: Column, paid: Column, ctx: RunContext) -> Column:
    """A direct deposit made in another month or year than its payment.

    A NULL deposit date gives NULL, which ``when`` treats as not late.
    """
    direct_deposit = ctx.text(form) == "DPC"
    other_month = F.month(deposited) != F.month(paid)
    other_year = F.year(deposited) != F.year(paid)
    return direct_deposit & (other_month | other_year)
