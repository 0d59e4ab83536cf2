"""Parameters of a posting run."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class CardRates:
    """Shares of a card payment: tax withheld, commission, and both together."""

    tax: float
    commission: float
    total: float


# Card rates per company, and for every company not listed.
CARD_RATES = {3: CardRates(tax=0.02, commission=0.035, total=0.055)}
DEFAULT_CARD_RATES = CardRates(tax=0.02, commission=0.04, total=0.06)


@dataclass(frozen=True)
class RunContext:
    """What a caller passes besides the slices.

    ``run_ts``        ingestion time; the clock of the run when None
    ``sink_decimal``  (precision, scale) of the journal's amount; None keeps double
    ``collation``     Spark collation for comparing codes; None compares bytes
    ``ext_only_for_company``  post second-system forms only in slices of this company;
                      None posts them in every slice, whatever its company
    ``keys_first``    write the insured lines of the slices and the numbers of their invoices and
                      work orders first, so that those of other days are dropped before they move:
                      for runs of few days against a long history. Costs four small writes
    """

    user: str = "SA"
    terminal: str = ""
    run_ts: datetime | None = None
    sink_decimal: tuple[int, int] | None = None
    collation: str | None = None
    ext_only_for_company: int | None = None
    keys_first: bool = False
    card_rates: dict[int, CardRates] = field(default_factory=lambda: dict(CARD_RATES))
    default_card_rates: CardRates = DEFAULT_CARD_RATES

    def ingestion_time(self) -> Column:
        if self.run_ts is None:
            return F.localtimestamp()
        return F.lit(self.run_ts).cast("timestamp_ntz")

    def text(self, column: Column) -> Column:
        """``column`` as it takes part in comparisons."""
        return F.collate(column, self.collation) if self.collation else column

    def card_rate(self, share: str, company: Column) -> Column:
        """Rate ``share`` (tax, commission or total) for the company that runs the slice."""
        rate = F.lit(getattr(self.default_card_rates, share))
        for code, rates in self.card_rates.items():
            rate = F.when(company == code, F.lit(getattr(rates, share))).otherwise(rate)
        return rate
