"""Mixing sources to target weights.

Every document gets a random key, a hash of its id and text, so each source has a random order
that reruns repeat. Key space is cut into as many ranges as the square root of the number of
rows. Sizes are summed for each source and range, running sums over the ranges of a source find the range
in which its budget ends, and running sums over the keys of that one range find the key.
Neither sum sees more than about that square root of rows at once, and no row of the corpus
moves: all it needs is its source's number of whole epochs, the key of the cut and what is left there.

A budget of q whole epochs and some words more takes every document q times, those before
the cut once more, and of the document at the cut just the words that are left, so a source gives
its target less a fraction of a word. Copies of a row share one key and are cut alike: words
that do not divide among them, fewer than there are copies, are not taken.

Weights go round by the order of sources; targets share the sum of all sizes and stop at
``max_epochs`` times a source's size, the excess going to the others by weight. With sources in
order of size by weight, ``level`` rises while sources are full and falls after; its largest
value is the one at which the shares add up. One row for each source is the largest table
that a single task sees besides the ranges: sources are what weights are given to.

Defined results: NULL texts have size 0 and take 0 words; a NULL source is a source of its own,
last in order; NULL ids and repeated rows are rows like others; a source without words has
target 0. Very long texts are counted whole, where they are. An empty table gives no rows. Other columns are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asiento.llm.tables import write_shared

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Parameters:
    weights: tuple[int, ...] = (1, 2, 3)  # of the sources in order, repeating
    max_epochs: int = 3
    seed: int = 42


def _columns(source: str, p: Parameters) -> list[Column]:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    hashed = F.xxhash64(F.lit(p.seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text)
    return [
        F.col(source).cast("string").alias("own_source"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("size"),
        F.shiftrightunsigned(hashed, 1).alias("key"),
    ]


def sized(docs: DataFrame, source: str, p: Parameters) -> DataFrame:
    """``doc_id, source, size, key``: key is 63 random bits, a function of the row."""
    return docs.select("doc_id", *_columns(source, p)).withColumnRenamed("own_source", "source")


def targets(sizes: DataFrame, p: Parameters = Parameters()) -> DataFrame:
    """``source, weight, source_size, target`` from ``source, source_size``, one row for each source."""
    at = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(w) for w in p.weights])
    weighed = sizes.withColumn("weight", F.get(cycle, (at % len(p.weights)).cast("int")))
    every = Window.partitionBy()
    filling = every.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(0, Window.unboundedFollowing)
    full = F.coalesce(F.sum("source_size").over(before), F.lit(0)) * p.max_epochs
    level = (F.sum("source_size").over(every) - full) / F.sum("weight").over(after)
    most = F.col("source_size") * p.max_epochs
    shared = weighed.withColumn("level", level).withColumn("level", F.max("level").over(every))
    target = F.least(most.cast("double"), F.col("weight") * F.col("level"))
    return shared.select("source", "weight", "source_size", target.alias("target"))


def _range(key: Column, ranges: int) -> Column:
    """The range of a key; ranges are numbered in the order of their keys."""
    return F.shiftright(F.shiftright(key, 31) * F.lit(ranges), 32)


def _holding(sums: DataFrame, goals: DataFrame, place: str) -> DataFrame:
    """For each source the place in which its running sum first passes ``rest``.

    ``sums`` holds ``source, place, words``; ``rest`` comes out less the words before that place.
    """
    before = Window.partitionBy("source").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    run = sums.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0))).alias("r")
    both = run.join(goals.alias("g"), F.col("r.source").eqNullSafe(F.col("g.source")))
    inside = (F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words"))
    return both.where(inside).select("r.source", place, "words", (F.col("rest") - F.col("before")).alias("rest"))


def cuts(stored: DataFrame, p: Parameters = Parameters()) -> DataFrame:
    """``source, source_size, target, epochs, cut, rest, at_cut``: what each source takes.

    ``cut`` is the key at which the budget ends, ``rest`` the words taken there of ``at_cut``.
    """
    ranges = max(1, int(stored.count() ** 0.5))
    in_range = _range(F.col("key"), ranges).alias("range")
    sums = write_shared(stored.groupBy("source", in_range).agg(F.sum("size").alias("words")), "ranges")
    goals = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), p)
    goals = goals.withColumn("budget", F.floor("target"))
    whole = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(0)
    goals = goals.withColumn("epochs", whole)
    goals = write_shared(goals.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size")), "targets")
    last = write_shared(_holding(sums, goals, "range"), "last_ranges")
    here = F.col("s.source").eqNullSafe(F.col("l.source")) & (in_range == F.col("l.range"))
    keys = stored.alias("s").join(last.alias("l"), here, "left_semi").groupBy("source", "key").agg(F.sum("size").alias("words"))
    at = _holding(keys, last.select("source", "rest"), "key").alias("a")
    return goals.alias("g").join(at, F.col("g.source").eqNullSafe(F.col("a.source")), "left").select(
        "g.source", "source_size", "target", "epochs", F.col("key").alias("cut"), F.col("a.rest").alias("rest"), F.col("words").alias("at_cut")
    )


def _taken() -> Column:
    """Words that the mix takes of a row, repeats counted, next to its source's cut."""
    share = F.expr("(CAST(rest AS DECIMAL(38, 0)) * size) DIV at_cut")
    at_cut = F.when(F.col("at_cut") > 0, share).otherwise(0)
    more = F.when(F.col("key") < F.col("cut"), F.col("size")).when(F.col("key") == F.col("cut"), at_cut).otherwise(0)
    return (F.col("epochs") * F.col("size") + more).cast("bigint")


def mix(docs: DataFrame, source: str = "source", p: Parameters = Parameters()) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken``, one row for each row of ``docs``."""
    stored = write_shared(sized(docs, source, p), "sized")
    found = write_shared(cuts(stored, p), "cuts").alias("c")
    both = stored.alias("s").join(found, F.col("s.source").eqNullSafe(F.col("c.source")))
    return both.select("doc_id", "s.source", "size", "source_size", "target", _taken().alias("taken"))


def mixture(docs: DataFrame, source: str = "source", p: Parameters = Parameters()) -> DataFrame:
    """The mix itself: ``row`` (the columns of ``docs``), ``epoch`` from 1, and ``mixed``, the text taken.

    Of a text that is taken in part the last epoch has the first words, a blank between them.
    """
    found = write_shared(cuts(write_shared(sized(docs, source, p), "sized"), p), "cuts").alias("c")
    held = docs.select(F.struct("*").alias("row"), *_columns(source, p))
    both = held.join(found, F.col("own_source").eqNullSafe(F.col("c.source"))).withColumn("taken", _taken())
    epochs = F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))
    copies = both.where("taken > 0").withColumn("epoch", F.explode(epochs))
    left = F.col("taken") - (F.col("epoch") - 1) * F.col("size")
    words = F.regexp_extract_all("row.text", F.lit(f"({WORD})"), F.lit(1))
    text = F.when(left >= F.col("size"), F.col("row.text")).otherwise(F.array_join(F.slice(words, 1, left.cast("int")), " "))
    return copies.select("row", "epoch", text.alias("mixed"))
