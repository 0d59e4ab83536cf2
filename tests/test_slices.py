"""Slice sets that cannot go wrong: numbers, collations, many slices, the last date."""

from __future__ import annotations

import time
from datetime import date, timedelta

import pytest
from conftest import ts
from pyspark.sql import functions as F

from asiento.context import RunContext
from asiento.slices import Slice, SliceSet
from asiento.sources.facts import write_by_day
from catalogue import fixtures

COLUMNS = "slice_id long, fecha date, empresa int, estado string"


@pytest.mark.parametrize("numbers", [(1, 1), (1, None)])
def test_numbers_must_be_unique_and_known(spark, numbers):
    rows = [(n, date(2024, 1, 5 + k), 1, "G") for k, n in enumerate(numbers)]
    with pytest.raises(ValueError, match="numbers"):
        SliceSet.from_frame(spark.createDataFrame(rows, COLUMNS))


def test_equal_states_are_one_slice(spark, billing):
    states = ("G", "g", "G ", "R")
    tables = billing(invoice_line=[dict(de_num_linea=n, de_estado=s) for n, s in enumerate(states)])
    ctx = RunContext(collation="UTF8_LCASE_RTRIM")
    fact = (tables.invoice_line, "de_fecha", "de_cod_empresa", "de_estado")
    slices = SliceSet.present(fact, ctx=ctx)
    assert slices.df.count() == 2 and SliceSet.present(fact).df.count() == 4
    assert slices.select_from(*fact[:1], ctx, *fact[1:]).count() == 4


def test_many_listed_slices_plan_soon(spark):
    days = [date(2015, 1, 1) + timedelta(days=n) for n in range(3650)]
    slices = SliceSet.calendar(spark, days, range(1, 11), ["G", "R"])
    began = time.time()
    assert slices.since_last_of(99) is slices
    rest = slices.since_last_of(3).for_company(4)
    assert rest.df.count() == len(rest.listed) == 2
    assert time.time() - began < 20


def test_the_last_date_there_is(spark, billing):
    tables = billing(invoice_line=[dict(de_fecha=ts("2024-01-05")), dict(de_fecha=ts("9999-12-31 10:00"))])
    slices = SliceSet.of(spark, [Slice(date(2024, 1, 5), 1, "G"), Slice(date.max, 1, "G")])
    found = slices.select_from(tables.invoice_line, RunContext(), "de_fecha", "de_cod_empresa", "de_estado")
    assert [r.slice_id for r in found.orderBy(F.col("slice_id")).collect()] == [1, 2]


def test_the_filter_stays_short_however_many_days(spark, sf_dir):
    """Code generated for thousands of days is no longer than for three: the JVM compiles it."""
    fact = fixtures.tables(spark, sf_dir, ["invoice_line"]).invoice_line
    debug = spark._jvm.org.apache.spark.sql.execution.debug.package
    lengths = []
    for count in (3, 2000):
        days = [date(1995, 1, 1) + timedelta(days=2 * n) for n in range(count)]
        slices = SliceSet.of(spark, [Slice(day, 1, "G") for day in days])
        kept = slices.select_from(fact, RunContext(), "de_fecha", "de_cod_empresa", "de_estado")
        plan = kept._jdf.queryExecution()
        assert plan.optimizedPlan().toString().count(" OR ") == 0
        lengths.append(len(debug.codegenString(plan.sparkPlan())))
    assert lengths[1] < 1.1 * lengths[0]


def test_exactly_the_days_partitions_are_read(spark, billing, tmp_path):
    days = [date(2024, 1, 1) + timedelta(days=n) for n in range(60)]
    lines = billing(invoice_line=[dict(de_fecha=ts(f"{day} 10:00"), de_numero=n) for n, day in enumerate(days)]).invoice_line
    write_by_day(lines, str(tmp_path / "lines"), "de_fecha")
    stored = spark.read.parquet(str(tmp_path / "lines"))
    slices = SliceSet.of(spark, [Slice(day, 1, "G") for day in days[::7]])
    kept = slices.select_from(stored, RunContext(), "de_fecha", "de_cod_empresa", "de_estado")
    assert sorted(r.de_numero for r in kept.collect()) == list(range(0, 60, 7))
    read = [f for f in stored.filter(slices.on_dates(stored, "de_fecha")).inputFiles()]
    assert len({f.split("de_fecha_dia=")[1][:10] for f in read}) >= 9
    text = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "unix_date(de_fecha_dia" in text
