"""License scans by sentence rules.

Texts are cut into pieces at line feeds and after the ends of sentences; pieces are brought to a plain
form (lower-case A-Z, runs of anything but letters and digits as one blank). Known sentences are
cut and made plain in the same way. A sentence is found where consecutive pieces together give its
words, so that it may be wrapped over lines at any blank; it begins and ends with a piece. A
text so becomes a sequence of sentences, the longest known one at each piece, or else the piece; a map gives
each known sentence its identifier. A rule is an ordered list of identifiers; it is met where they follow each
other with nothing between. Rules are taken from the left, the longest first, so that a rule covers its parts.
Numbers and bullets of lists are left out if the line before ended a sentence or was empty.

Sentences and rules are fixed lists, so both are small whatever the corpus. Everything is a
function of one text: one pass, no shuffle, and one search for all sentences, however many are known.
Very long texts are taken whole; a text takes some times its size in memory while its pieces are made.

Defined results: NULL and empty texts meet no rule; a text can meet several rules, or one in
several places. Copies of a row come out as often as they came in. Other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asiento.llm.licence_rules import RULES, SENTENCES
from asiento.llm.tables import fold_ascii

#: A piece ends at a line feed, or after one of .!?: before white space.
PIECE_END = r"\n|(?<=[.!?:])[ \t]+"
PLAIN = r"[^0-9a-z\x80-\x{10FFFF}]+"
#: A number, letter or bullet at the head of a line, where the line before can't go on.
LIST_MARK = (
    r"(\A|[.!?:;][^0-9A-Za-z\x80-\x{10FFFF}]*?\n|\n[^0-9A-Za-z\x80-\x{10FFFF}\n]*\n)[^0-9A-Za-z\x80-\x{10FFFF}\n]*"
    r"(?:[•‣◦▪·–—]|(?:[0-9]{1,3}|[A-Za-z]|[ivxIVX]{2,4})[.)])[ \t]+"
)


#: Stands for a sentence that is not in the list.
UNKNOWN = "-"


def plain(piece: Column) -> Column:
    return F.trim(F.regexp_replace(fold_ascii(piece), PLAIN, " "))


def pieces(text: Column) -> Column:
    """The pieces of a text in order, in plain form, without empty ones."""
    text = F.replace(text, F.lit("https://"), F.lit("http://"))
    text = F.regexp_replace(text, LIST_MARK, "$1")
    return F.filter(F.transform(F.split(text, PIECE_END), plain), lambda s: s != "")


def wordings(spark: SparkSession, sentences: dict[str, str | tuple[str, ...]]) -> dict[str, str]:
    """The identifier of each sentence of the fixed list, by its plain words."""
    given = [(name, s) for name, known in sentences.items() for s in ((known,) if isinstance(known, str) else known)]
    rows = spark.createDataFrame(given, "name string, sentence string")
    return {r.words: r.name for r in rows.select("name", F.array_join(pieces(F.col("sentence")), " ").alias("words")).collect()}


def any_of(parts: Iterable[str]) -> str:
    """A pattern for one of ``parts``, a longer one before its beginnings."""
    return "|".join(sorted(parts, key=len, reverse=True))


def lookup(names: dict[str, str], key: Column) -> Column:
    entries = [F.lit(x) for pair in names.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*entries), key), F.lit(UNKNOWN))


def sentences_of(cut: Column, known: dict[str, str]) -> Column:
    """The identifiers of a text's sentences in order, ``UNKNOWN`` for others; empty if no sentence is known.

    ``cut`` holds the pieces, each after a line feed, and one more at the end.
    """
    # Between words a piece may end; at the end of a sentence one must.
    found = any_of(words.replace(" ", "[ \n]") for words in known)
    runs = F.regexp_extract_all(cut, F.lit(f"\n({found}|[^\n]+)(?=\n)"), F.lit(1))
    named = F.transform(runs, lambda run: lookup(known, F.translate(run, "\n", " ")))
    return F.when(F.rlike(cut, F.lit(f"\n(?:{found})(?=\n)")), named).otherwise(F.array().cast("array<string>"))


def licences(
    docs: DataFrame, sentences: dict[str, str | tuple[str, ...]] = SENTENCES, rules: dict[str, list[list[str]]] = RULES
) -> DataFrame:
    """``doc_id, licences`` (sorted, distinct) and ``n_matches`` for each row of ``docs``."""
    known = wordings(docs.sparkSession, sentences)
    met_by = {"\n".join(names): licence for licence, variants in rules.items() for names in variants}
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    cut = docs.select("doc_id", F.concat(F.lit("\n"), F.array_join(pieces(text), "\n"), F.lit("\n")).alias("cut"))
    named = cut.select("doc_id", sentences_of(F.col("cut"), known).alias("names"))
    sequence = F.concat(F.lit("\n"), F.array_join("names", "\n"), F.lit("\n"))
    places = F.regexp_extract_all(sequence, F.lit(f"\n({any_of(met_by)})(?=\n)"), F.lit(1))
    met = named.select("doc_id", F.when(F.size("names") > 0, F.transform(places, lambda p: lookup(met_by, p))).otherwise(F.array().cast("array<string>")).alias("met"))
    return met.select(
        "doc_id", F.array_sort(F.array_distinct("met")).alias("licences"), F.size("met").cast("bigint").alias("n_matches")
    )
