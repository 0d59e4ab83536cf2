"""Slices: which (date, company, state) combinations a job posts.

One slice is one call of a posting procedure. A backfill passes many slices and still
reads each fact table once.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asiento.context import RunContext
from asiento.sources.facts import day_column
from asiento.sources.shared import write_shared

COLUMNS = ("slice_id", "fecha", "empresa", "estado")
# What a journal row carries of its slice until it reaches the journal.
ROW_COLUMNS = ("slice_id", "slice_fecha", "slice_empresa")


def as_date(value: date | datetime | str) -> date:
    """Truncate a date-time to its date; text must be ISO, anything else raises."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    return value.date() if isinstance(value, datetime) else value


def day_number(day: date) -> int:
    """Days since 1970-01-01, as ``unix_date`` counts them."""
    return day.toordinal() - date(1970, 1, 1).toordinal()


@dataclass(frozen=True)
class Slice:
    fecha: date
    empresa: int
    estado: str

    def __post_init__(self):
        object.__setattr__(self, "fecha", as_date(self.fecha))


@dataclass(frozen=True)
class SliceSet:
    """Slices in run order: ``slice_id`` is unique and sorts in the order of the runs.

    ``df`` holds the slices. ``listed`` repeats them on the driver, by ``slice_id``, when
    the caller gave them as a list, so that their values reach the scans as literals.
    ``days`` are the calendar days of the slices in order, known for both kinds. Of computed
    slices, ``empresa`` and ``estado`` hold the value that all of them share, if they do.
    """

    df: DataFrame
    listed: dict[int, Slice] | None = None
    days: tuple[date, ...] = ()
    empresa: int | None = None
    estado: str | None = None

    # -- builders ---------------------------------------------------------------

    @staticmethod
    def of(spark: SparkSession, slices: Iterable[Slice | tuple]) -> SliceSet:
        """Slices listed by the caller, numbered 1..n in the order given."""
        given = [s if isinstance(s, Slice) else Slice(*s) for s in slices]
        listed = dict(enumerate(given, start=1))
        # An Arrow table becomes a local relation, whose exact size Spark knows.
        rows = pa.table(
            {
                "slice_id": pa.array(listed.keys(), pa.int64()),
                "fecha": pa.array([s.fecha for s in given], pa.date32()),
                "empresa": pa.array([s.empresa for s in given], pa.int32()),
                "estado": pa.array([s.estado for s in given], pa.string()),
            }
        )
        days = tuple(sorted({s.fecha for s in given}))
        return SliceSet(spark.createDataFrame(rows), listed, days)

    @staticmethod
    def calendar(
        spark: SparkSession,
        dates: Iterable[date],
        companies: Iterable[int],
        states: Iterable[str],
    ) -> SliceSet:
        """Every company and state on every date, in date order."""
        companies, states = list(companies), list(states)
        return SliceSet.of(
            spark, (Slice(d, c, s) for d in sorted(dates) for c in companies for s in states)
        )

    @staticmethod
    def present(
        *facts: tuple[DataFrame, str, str, str], ctx: RunContext = RunContext()
    ) -> SliceSet:
        """The slices that occur in facts given as (table, date, company, state column).

        States that ``ctx`` takes for equal are one slice; pass the context of the runs. The distinct combinations are as many as days x companies x states. They are
        written once to the shared folder: that gives the later joins a measured size.
        """
        found = None
        for df, fecha, empresa, estado in facts:
            part = df.select(
                F.to_date(fecha).alias("fecha"),
                F.col(empresa).cast("int").alias("empresa"),
                F.col(estado).alias("estado"),
            )
            found = part if found is None else found.unionByName(part)
        found = (
            found.dropna()
            .groupBy("fecha", "empresa", ctx.text(F.col("estado")).alias("compared"))
            .agg(F.min(F.col("estado")).alias("estado"))
            .drop("compared")
        )
        # An ISO date, a padded company and the state sort like the slice itself.
        slice_id = F.concat_ws(
            "|",
            F.col("fecha").cast("string"),
            F.lpad(F.col("empresa").cast("string"), 10, "0"),
            F.col("estado"),
        )
        return SliceSet.from_frame(found.withColumn("slice_id", slice_id))

    @staticmethod
    def from_frame(df: DataFrame) -> SliceSet:
        """Slices computed by a query: written once, read back with a known size.

        Raises ValueError unless every slice has a number of its own.
        """
        stored = write_shared(df.select(*COLUMNS), "slices")
        n, numbered, distinct = stored.agg(
            F.count("*"), F.count("slice_id"), F.count_distinct("slice_id")
        ).first()
        if not n == numbered == distinct:
            raise ValueError(f"{n} slices have {distinct} different numbers, {n - numbered} have none")
        return SliceSet._measured(stored)

    @staticmethod
    def _measured(stored: DataFrame) -> SliceSet:
        """What the scans may know: one row, with one entry for each calendar day that occurs."""
        row = stored.agg(
            F.collect_set("fecha").alias("days"),
            *(f(c).alias(f"{f.__name__}_{c}") for c in ("empresa", "estado") for f in (F.min, F.max)),
        ).first()
        empresa = row.min_empresa if row.min_empresa == row.max_empresa else None
        estado = row.min_estado if row.min_estado == row.max_estado else None
        return SliceSet(stored, None, tuple(sorted(row.days)), empresa, estado)

    def _keep(self, numbers: Iterable[int], condition: Column | None = None) -> SliceSet:
        """Some of the listed slices, with their numbers; ``condition`` says the same in a few words."""
        kept = {n: self.listed[n] for n in numbers}
        if len(kept) == len(self.listed):
            return self
        days = tuple(sorted({s.fecha for s in kept.values()}))
        df = self.df.filter(F.col("slice_id").isin(list(kept)) if condition is None else condition)
        return SliceSet(df, kept, days)

    # -- use --------------------------------------------------------------------

    @property
    def only(self) -> tuple[int, Slice] | None:
        """Number and slice, when exactly one is listed."""
        if self.listed is None or len(self.listed) != 1:
            return None
        return next(iter(self.listed.items()))

    def for_company(self, company: int) -> SliceSet:
        """The slices of one company."""
        if self.listed is not None:
            numbers = (n for n, s in self.listed.items() if s.empresa == company)
            return self._keep(numbers, F.col("empresa") == company)
        return replace(self, df=self.df.filter(F.col("empresa") == company), empresa=company)

    def last_of_companies(self) -> SliceSet:
        """The last slice of each company."""
        if self.listed is not None:
            return self._keep({s.empresa: n for n, s in self.listed.items()}.values())
        last = self.df.groupBy("empresa").agg(
            F.max("slice_id").alias("slice_id"),
            F.max_by(F.struct("fecha", "estado"), "slice_id").alias("of"),
        )
        return SliceSet._measured(last.select("slice_id", "of.fecha", "empresa", "of.estado"))

    def since_last_of(self, company: int) -> SliceSet:
        """The last slice of a company and all later ones; every slice if it has none."""
        if self.listed is not None:
            last = max((n for n, s in self.listed.items() if s.empresa == company), default=None)
            if last is None:
                return self
            return self._keep((n for n in self.listed if n >= last), F.col("slice_id") >= last)
        of_company = self.df.filter(F.col("empresa") == company)
        last = of_company.agg(F.max("slice_id")).first()[0]
        if last is None:
            return self
        return SliceSet._measured(self.df.filter(F.col("slice_id") >= F.lit(last)))

    def companies(self) -> DataFrame:
        return self.df.select("empresa").distinct()

    def on_dates(self, fact: DataFrame, column: str) -> Column:
        """``column`` lies between the slices' first and last day: a range that scans can push.

        Days left out in between are told by the join with the slices, one look-up a row;
        a test for each of them here would make the generated code too long for the JVM to
        compile. A fact written by day is also limited to the partitions of exactly these days,
        which costs the driver one look-up a partition and no row anything.
        """
        if not self.days:
            return F.lit(False)
        if len(self.days) == 1:
            inside = F.to_date(column) == F.lit(self.days[0])
        else:
            inside = self._in_range(column, self.days[0], self.days[-1])
        if day_column(column) in fact.columns:
            # As text, since thousands of literals are parsed faster than they are built one by one.
            numbers = ", ".join(str(day_number(day)) for day in self.days)
            inside = inside & F.expr(f"unix_date(`{day_column(column)}`) IN ({numbers})")
        return inside

    @staticmethod
    def _in_range(column: str, first: date, last: date) -> Column:
        inside = F.col(column) >= F.lit(first).cast("timestamp_ntz")
        if last < date.max:  # no day follows the last one there is
            until = F.lit(last + timedelta(days=1)).cast("timestamp_ntz")
            inside = inside & (F.col(column) < until)
        return inside

    def in_companies(self, column: str) -> Column:
        if self.listed is None:
            return F.col(column).isNotNull() if self.empresa is None else F.col(column) == self.empresa
        return F.col(column).isin(sorted({s.empresa for s in self.listed.values()}))

    def in_states(self, column: str, ctx: RunContext) -> Column:
        if self.listed is None:
            known = self.estado is not None
            return ctx.text(F.col(column)) == self.estado if known else F.col(column).isNotNull()
        states = sorted({s.estado for s in self.listed.values()})
        if not states:
            return F.lit(False)
        matches = ctx.text(F.col(column)) == states[0]
        for state in states[1:]:
            matches = matches | (ctx.text(F.col(column)) == state)
        return matches

    def narrow(
        self,
        fact: DataFrame,
        ctx: RunContext,
        fecha: str | None = None,
        empresa: str | None = None,
        estado: str | None = None,
    ) -> DataFrame:
        """Rows of ``fact`` that some slice could take, each once, judged by these columns.

        For tables that take part of their slice from another table: it keeps rows of no
        use out of the join between the two.
        """
        kept = self._within(fact, ctx, fecha, empresa, estado)
        if self.only is not None:
            return kept
        keys = []
        if fecha is not None:
            keys.append(self._day(fact, fecha) == F.col("slice_fecha"))
        if self.listed is None:
            # Companies and states of listed slices are literals in the filter already.
            if empresa is not None:
                keys.append(F.col(empresa) == F.col("slice_empresa"))
            if estado is not None:
                keys.append(ctx.text(F.col(estado)) == ctx.text(F.col("slice_estado")))
        if not keys:
            return kept
        match = keys[0]
        for key in keys[1:]:
            match = match & key
        return kept.join(self._renamed(), match, "left_semi")

    def select_from(
        self,
        fact: DataFrame,
        ctx: RunContext,
        fecha: str,
        empresa: str | None = None,
        estado: str | None = None,
    ) -> DataFrame:
        """Rows of ``fact`` that lie in a slice, with the slice's number, date and company.

        A row in several slices comes out once for each. Columns not named are not
        compared. One listed slice is a plain filter; several are an equi join with the
        slice table, which Spark broadcasts as long as its known size allows.
        """
        kept = self._within(fact, ctx, fecha, empresa, estado)
        if self.only is not None:
            number, one = self.only
            return kept.withColumns(
                {
                    "slice_id": F.lit(number).cast("bigint"),
                    "slice_fecha": F.lit(one.fecha),
                    "slice_empresa": F.lit(one.empresa),
                }
            )
        match = self._day(fact, fecha) == F.col("slice_fecha")
        if empresa is not None:
            match = match & (F.col(empresa) == F.col("slice_empresa"))
        if estado is not None:
            match = match & (ctx.text(F.col(estado)) == ctx.text(F.col("slice_estado")))
        return kept.join(self._renamed(), match, "inner").drop("slice_estado")

    def _within(
        self,
        fact: DataFrame,
        ctx: RunContext,
        fecha: str | None,
        empresa: str | None,
        estado: str | None,
    ) -> DataFrame:
        """Filters with literals, which reach the scan."""
        kept = fact
        if fecha is not None:
            kept = kept.filter(self.on_dates(fact, fecha))
        if empresa is not None:
            kept = kept.filter(self.in_companies(empresa))
        if estado is not None:
            kept = kept.filter(self.in_states(estado, ctx))
        return kept

    def _renamed(self) -> DataFrame:
        return self.df.select(
            "slice_id",
            F.col("fecha").alias("slice_fecha"),
            F.col("empresa").alias("slice_empresa"),
            F.col("estado").alias("slice_estado"),
        )

    @staticmethod
    def _day(fact: DataFrame, fecha: str) -> Column:
        """The date; the day column, where there is one, lets Spark prune partitions."""
        by_day = day_column(fecha) in fact.columns
        return F.col(day_column(fecha)) if by_day else F.to_date(fecha)
