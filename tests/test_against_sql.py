"""Every named query returns the rows its check statement returns."""

import duckdb
import pytest

import __spark_entry__ as entry_points
import check
from catalogue import fixtures
from catalogue.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return check.database(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, con, sf_dir, name):
    verdict, _, _ = check.compare(spark, con, sf_dir, name)
    assert verdict == "ok"


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())


def test_entry_returns_rows(spark):
    assert entry_points.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_calendars_cover_the_tables(sf):
    """No line and no form lies outside the slices the queries run over."""
    con = duckdb.connect()
    months = con.execute(
        f"SELECT DISTINCT date_trunc('month', l_shipdate)::DATE FROM '/root/testdata/{sf}/lineitem.parquet'"
    ).fetchall()
    assert {m for (m,) in months} <= set(fixtures.INVOICE_MONTHS)
    days = con.execute(
        f"SELECT DISTINCT ts::DATE FROM '/root/testdata/{sf}/events.parquet'"
    ).fetchall()
    assert {d for (d,) in days} <= set(fixtures.PAYMENT_DAYS)
