"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item is a set of windows of ``window`` consecutive words; a shorter item is one
window. A text holds a window only if it holds every shingle of it, so with full
containment the necessary prefix of a window, with its shingles in order of rarity, is the rarest one
alone. Texts are joined with these prefixes, the positions bound where the window can lie, and
the words there are compared in full.

* One pass cuts each text into words and keeps the positions of shingles that may belong to a
  benchmark: a bitmap of fixed size (``bits``) says so without a join. What it lets through in
  error finds no partner later.
* Rarity is the number of these positions over all texts.
* The join is an equi join on the shingle, whose big side Spark can split where a passage is
  common. Windows are distinct, so an item that is listed often costs nothing.

Defined results: NULL and empty texts have no words and are clean; items without words have
no windows; NULL item ids are counted as the string ``null``; repeated items count once by id;
copies of a row come out as often as they came in. Other columns are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asiento.llm.tables import fold_ascii, row_key, write_shared

BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Parameters:
    window: int = 10  # words
    shingle: int = 3  # words
    bits: int = 1 << 22  # of the bitmap that every task holds


def words_of(text: Column) -> Column:
    folded = fold_ascii(F.coalesce(text.cast("string"), F.lit("")))
    return F.array_remove(F.split(folded, BETWEEN_WORDS), "")


def shingle_at(words: Column, at: Column, size: int) -> Column:
    """Hash of ``size`` words from position ``at``, counted from 0."""
    return F.xxhash64(*[F.get(words, at + k) for k in range(size)])


def windows_of(benchmark: DataFrame, p: Parameters) -> DataFrame:
    """``item, win, size, words``: each window of each item."""
    cut = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), words_of(F.col("text")).alias("all"))
    start = F.explode(F.sequence(F.lit(0), F.greatest(F.size("all") - p.window, F.lit(0))))
    placed = cut.where(F.size("all") > 0).select("item", "all", start.alias("at"))
    words = F.slice("all", F.col("at") + 1, p.window)
    return placed.select("item", words.alias("words")).select("item", F.array_join("words", " ").alias("win"), F.size("words").alias("size"), "words")


def shingles_of(windows: DataFrame, p: Parameters) -> DataFrame:
    """``win, size, k, at, h``: the shingles of each distinct window; k words, or all if fewer."""
    distinct = windows.select("win", "size", "words").dropDuplicates(["win"])
    parts = [
        distinct.where(F.col("size") >= k if k == p.shingle else F.col("size") == k).select(
            "win", "size", F.lit(k).alias("k"), "words",
            F.explode(F.sequence(F.lit(0), F.col("size") - k)).alias("at"),
        ).withColumn("h", shingle_at(F.col("words"), F.col("at"), k)).drop("words")
        for k in range(1, p.shingle + 1)
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def bitmap(shingles: DataFrame, p: Parameters) -> DataFrame:
    """One row with an array of ``bits / 64`` integers."""
    spark = shingles.sparkSession
    place = F.pmod("h", F.lit(p.bits))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(place, F.lit(64)).cast("int"))
    filled = shingles.select(F.shiftright(place, 6).alias("n"), bit.alias("bit")).groupBy("n").agg(F.bit_or("bit").alias("b"))
    every = spark.range(p.bits // 64).toDF("n").join(filled, "n", "left").select("n", F.coalesce("b", F.lit(0)).alias("b"))
    rows = F.array_sort(F.collect_list(F.struct("n", "b")))
    return every.agg(F.transform(rows, lambda r: r["b"]).alias("bitmap"))


def occurrences(docs: DataFrame, shingles: DataFrame, p: Parameters) -> DataFrame:
    """``doc_id, row_key, n_words, k, pos, h, around``: where shingles of the benchmark may lie.

    ``around`` holds the words that a window with this shingle can reach. Each row of ``docs``
    also gives one row without a shingle.
    """
    kinds = sorted(r.k for r in shingles.select("k").distinct().collect())  # at most ``shingle`` rows
    words, h = F.col("words"), F.col("f.h")

    def of_size(k: int) -> Column:
        starts = F.when(F.size(words) >= k, F.sequence(F.lit(0), F.size(words) - k)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.struct(F.lit(k).alias("k"), i.alias("pos"), shingle_at(words, i, k).alias("h")))

    none = F.array(F.lit(None).cast("struct<k:int,pos:int,h:bigint>"))
    cut = docs.select("doc_id", row_key(F.col("text")).alias("row_key"), words_of(F.col("text")).alias("words"))
    every = cut.select("doc_id", "row_key", "words", F.explode(F.concat(none, *[of_size(k) for k in kinds])).alias("f"))

    place = F.pmod(h, F.lit(p.bits))
    word = F.get(bitmap(shingles, p).scalar(), F.shiftright(place, 6).cast("int"))
    known = F.call_function("shiftrightunsigned", word, F.pmod(place, F.lit(64)).cast("int")).bitwiseAND(F.lit(1)) == 1
    reach = p.window - F.col("f.k")
    around = F.slice(words, F.greatest(F.col("f.pos") - reach, F.lit(0)) + 1, 2 * reach + F.col("f.k"))
    return every.where(h.isNull() | known).select(
        "doc_id", "row_key", F.size("words").cast("bigint").alias("n_words"), "f.*",
        F.when(h.isNotNull(), around).alias("around"),
    )


def same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["row_key"] == b["row_key"])


def contamination(docs: DataFrame, benchmark: DataFrame, p: Parameters = Parameters()) -> DataFrame:
    """``doc_id, row_key, n_words, n_hit, items``, one row for each row of ``docs``."""
    windows = write_shared(windows_of(benchmark, p), "windows")
    shingles = shingles_of(windows, p)
    texts = write_shared(occurrences(docs, shingles, p), "occurrences")
    placed = texts.where("h IS NOT NULL")

    # Order the shingles of each window by rarity; the first is its prefix.
    rarity = placed.groupBy("h", "k").agg(F.count("*").alias("n"))
    ranked = shingles.join(rarity, ["h", "k"])  # a shingle found nowhere rules its window out
    prefix = ranked.groupBy("win", "size").agg(F.min(F.struct("n", "h", "k", "at")).alias("p")).select("win", "size", "p.h", "p.k", "p.at")

    # Probe; bounds of position and length; compare the words themselves.
    start = F.col("pos") - F.col("at")
    inside = (start >= 0) & (start + F.col("size") <= F.col("n_words"))
    first = F.greatest(F.col("pos") - (p.window - F.col("k")), F.lit(0))
    there = F.array_join(F.slice("around", start - first + 1, F.col("size")), " ")
    probed = placed.join(prefix, ["h", "k"]).where(inside)
    hits = probed.where(there == F.col("win")).select("doc_id", "row_key", start.alias("start"), "size", "win").distinct()

    # Words inside any occurrence: the union of intervals along the text.
    along = Window.partitionBy("doc_id", "row_key").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = hits.select("doc_id", "row_key", "start", (F.col("start") + F.col("size")).alias("end")).distinct()
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(along), F.lit(0))))
    covered = spans.withColumn("fresh", fresh).groupBy("doc_id", "row_key").agg(F.sum("fresh").alias("n_hit"))

    holders = hits.select("doc_id", "row_key", "win").distinct().join(windows.select("win", "item").distinct(), "win")
    items = holders.groupBy("doc_id", "row_key").agg(F.array_sort(F.collect_set("item")).alias("items"))

    found = covered.join(items, same_row(covered, items)).select(covered["*"], "items")
    return (
        texts.where("h IS NULL").select("doc_id", "row_key", "n_words")
        .join(found.withColumnsRenamed({"doc_id": "id", "row_key": "key"}), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("row_key") == F.col("key")), "left")
        .select("doc_id", "row_key", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    )


def clean(docs: DataFrame, benchmark: DataFrame, p: Parameters = Parameters()) -> DataFrame:
    """The rows of ``docs`` that hold no window of the benchmark."""
    dirty = contamination(docs, benchmark, p).where("n_hit > 0").select(F.col("doc_id").alias("id"), F.col("row_key").alias("key")).distinct()
    held = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("own_id"), row_key(F.col("text")).alias("own_key"))
    same = F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_key") == F.col("key"))
    return held.join(dirty, same, "left_anti").select("row.*")
