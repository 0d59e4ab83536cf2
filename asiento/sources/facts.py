"""Fact tables on files, partitioned so that a slice reads its own days only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def day_column(column: str) -> str:
    """The partition column that holds the date of a date-time column."""
    return f"{column}_dia"


def write_by_day(
    fact: DataFrame,
    path: str,
    column: str,
    company: str | None = None,
    mode: str = "errorifexists",
    order: tuple[str, ...] = (),
) -> None:
    """Write a fact table in one partition per day, and per company if its column is named.

    Slices find the day column by its name and prune partitions with it. Rebalancing keeps
    the files of a day few, and splits a day or company that holds most of the rows. Rows are
    in ``order`` within a file (state, say), so that the statistics of its row groups prune by these columns too.
    """
    keys = [day_column(column)] + ([company] if company else [])
    placed = fact.withColumn(day_column(column), F.to_date(column)).hint("rebalance", *keys)
    if order:
        placed = placed.sortWithinPartitions(*keys, *order)
    placed.write.mode(mode).partitionBy(*keys).parquet(path)
