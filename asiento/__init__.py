"""Accounting-journal posting on Spark: billing facts in, signed journal rows out."""

from asiento.context import CardRates, RunContext
from asiento.slices import Slice, SliceSet
from asiento.sources.tables import Tables

__all__ = ["CardRates", "RunContext", "Slice", "SliceSet", "Tables"]
