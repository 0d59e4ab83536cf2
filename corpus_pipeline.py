"""A corpus pipeline: five stages, each on what the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next one's ``docs``. All but the last return the columns of ``documents``. An empty
table passes through every stage, and texts of any length are taken whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from asiento.llm.bpe_coding import encode_texts
from asiento.llm.decontaminate import clean
from asiento.llm.language_id import fit, keep_known
from asiento.llm.line_dedup import drop_boilerplate
from asiento.llm.simhash import one_of_each
from asiento.llm.tables import read_table, ship, write_shared

VOCABULARY = "word_bpe_49k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts too far from every language of the input go; so do NULL texts and those without a letter. Copies are decided alike."""
    ship(spark)
    return keep_known(docs, fit(docs.select("text", "lang")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are on many sources go from the texts; NULL and empty texts stay as they are, copies come out alike."""
    return drop_boilerplate(docs)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One text of each group of near-duplicates stays; NULL, empty and blank texts are one such group."""
    ship(spark)
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that hold a passage of the benchmark go; NULL and empty texts hold none, copies are decided alike."""
    return clean(docs, read_table(spark, sf_dir, "benchmark"))


def bpe_coding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids of each text, and of what they decode to; NULL counts as empty, and every row gives one."""
    ship(spark)
    return encode_texts(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash", simhash),
    ("decontamination", decontamination),
    ("bpe_coding", bpe_coding),
]

# Clusters of texts and of fingerprints have no statement in SQL; tests hold a brute-force run.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_shared(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
