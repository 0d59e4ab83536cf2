"""The queries of this subpackage, each over its whole tables, and their check statements."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asiento.llm.bpe_coding import encode_texts
from asiento.llm import oracle
from asiento.llm.collocations import collocations
from asiento.llm.decontaminate import contamination
from asiento.llm.language_id import fit, identify
from asiento.llm.licences import licences
from asiento.llm.line_dedup import without_boilerplate
from asiento.llm.lm_score import score_texts
from asiento.llm.mixing import mix
from asiento.llm.prefix_trie import branched_trie
from asiento.llm.quality_rules import quality_rules
from asiento.llm.simhash import near_duplicates
from asiento.llm.suffix_dedup import remove_repeats
from asiento.llm.tables import fold_of, read_table, ship
from asiento.llm.token_counts import token_counts

VOCABULARY = "word_bpe_49k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]):
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return run(spark, sf_dir)

    QUERIES[run.__name__] = shipped
    if sql := oracle.SQL.get(run.__name__):
        ORACLE[run.__name__] = sql
    return run


@query
def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold_of(F.col("doc_id"), 5) == 1
    found = score_texts(read_table(spark, sf_dir, "documents"), ~held_out)
    return found.withColumn("held_out", held_out)


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = fold_of(F.col("doc_id"), 4) == 2
    model = fit(docs.where(~held_out).select("text", "lang"))
    return identify(docs, model).withColumn("held_out", held_out)


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    digest = F.sha2(F.array_join("items", ","), 256)
    return contamination(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("licences", ",").alias("licences"), "n_matches")


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_boilerplate(read_table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


@query
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents")).drop("kept")


@query
def op7_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents"))


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query
def op9_bpe_coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(read_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return branched_trie(read_table(spark, sf_dir, "conversations"))


@query
def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents"))
