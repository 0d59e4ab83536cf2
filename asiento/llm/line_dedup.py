"""Line dedup by distinct-site spread.

A line that appears on many sites is boilerplate. Every distinct line gets a HyperLogLog
sketch of the sites it was seen on; partial sketches merge in the aggregation, so a line that is on a
third of all pages is never gathered anywhere. Sketches estimate; lines whose estimate lies near the
threshold get an exact count of sites, so the decision is that of exact counts.

Lines are cut at line feeds and compared without the white space around them; blank lines are
never boilerplate. A text that has nothing but boilerplate lines is a copy as a whole: it is left to
near-duplicate removal, and keeps its lines.

Defined results: NULL and empty texts have no lines and stay as they are; rows without a site
count as one more site; copies of a row are decided alike. Texts of any length are taken whole, each in the
memory of one task. Other columns are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asiento.llm.tables import row_key, write_shared

BARE = " \t\n\x0b\f\r"


@dataclass(frozen=True)
class Parameters:
    min_sites: int = 8
    log_registers: int = 12  # of a sketch: relative standard error 1.04 / sqrt(2^12)
    sigmas: float = 6.0  # half width of what counts as near the threshold

    @property
    def near(self) -> float:
        return max(1.0, self.sigmas * 1.04 / 2 ** (self.log_registers / 2) * self.min_sites)


def lines_of(docs: DataFrame, site: str) -> DataFrame:
    """``doc_id, row_key, site, no, h, length``: each line that is not blank."""
    text = F.col("text").cast("string")
    cut = docs.where("text IS NOT NULL").select(
        "doc_id", row_key(text).alias("row_key"), F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"),
        F.posexplode(F.split(text, "\n")).alias("no", "line"),
    )
    bare = F.trim("line", F.lit(BARE))
    return cut.select("doc_id", "row_key", "site", "no", F.xxhash64(bare).alias("h"), F.length(bare).alias("length")).where("length > 0")


def boilerplate(lines: DataFrame, p: Parameters) -> DataFrame:
    """``h, length`` of the lines on at least ``min_sites`` sites."""
    sketch = F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(p.log_registers)))
    spread = lines.groupBy("h", "length").agg(sketch.alias("sites"))
    wide = spread.where(F.col("sites") > p.min_sites + p.near).select("h", "length")
    close = spread.where(F.abs(F.col("sites") - p.min_sites) <= p.near).select("h", "length")
    # Written, these lists have a known size: Spark broadcasts them under its threshold, and beyond it
    # joins two plain exchanges, of which it splits a line that is on a third of all pages.
    close = write_shared(close, "close")
    exact = lines.select("h", "length", "site").join(close, ["h", "length"], "left_semi").distinct()
    counted = exact.groupBy("h", "length").agg(F.count("*").alias("sites"))
    return wide.union(counted.where(F.col("sites") >= p.min_sites).select("h", "length"))


def without_boilerplate(docs: DataFrame, site: str = "source", p: Parameters = Parameters()) -> DataFrame:
    """``row`` (the columns of ``docs``), ``n_lines``, ``n_removed`` and ``kept``, one for each row."""
    lines = lines_of(docs, site)
    common = write_shared(boilerplate(lines, p), "common")
    found = lines.join(common, ["h", "length"]).groupBy("doc_id", "row_key").agg(F.collect_set("no").alias("drop"))
    text = F.col("row.text").cast("string")
    held = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("own_id"), row_key(F.col("text")).alias("own_key"))
    same = F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_key") == F.col("row_key"))
    both = held.join(found, same, "left")
    all_lines = F.split(text, "\n")
    every = F.when(F.size(all_lines) > 0, F.sequence(F.lit(0), F.size(all_lines) - 1))
    staying = F.array_except(every, F.col("drop"))
    left = F.array_join(F.transform(staying, lambda i: F.get(all_lines, i)), "\n")
    spared = F.col("drop").isNull() | (F.length(F.trim(left, F.lit(BARE))) == 0)
    shown = F.when(text.isNull() | (text == ""), 0).otherwise(F.size(all_lines))
    return both.select(
        "row",
        shown.cast("bigint").alias("n_lines"),
        F.when(spared, 0).otherwise(F.size("drop")).cast("bigint").alias("n_removed"),
        F.when(spared, text).otherwise(left).alias("kept"),
    )


def drop_boilerplate(docs: DataFrame, site: str = "source", p: Parameters = Parameters()) -> DataFrame:
    """The rows of ``docs`` with boilerplate lines taken out of ``text``."""
    return without_boilerplate(docs, site, p).select(
        F.col("row").withField("text", F.col("kept")).alias("row")
    ).select("row.*")
