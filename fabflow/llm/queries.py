"""Registered queries of the subpackage, one ``opN_<name>`` per operator, and their DuckDB SQL.

Each query applies its operator with production parameters to the whole table and derives the
digest columns of its contract from the operator's own output.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fabflow.llm import (
    bpe_tree, decontaminate, language_id, license_join, pairwise_quality, piece_counts, simhash_grid, source_divergence,
    substring_blocks, suffix_rules, toxicity_mil, url_segments, vector_codes,
)
from fabflow.llm.rows import read_table


def op1_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_tree.digests(bpe_tree.encode_decode(
        read_table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN))


def op2_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = pairwise_quality.train(docs, read_table(spark, sf_dir, "labels"), "quality", folds=4, held_out=2)
    return pairwise_quality.predictions(pairwise_quality.score(docs, model), "doc_id", 4, 2, 0.7)


def op3_simhash_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash_grid.near_duplicates(read_table(spark, sf_dir, "documents"), width=3, bits=2)
    return near.select("doc_id", simhash_grid.hex_of("fp").alias("fingerprint"), near["component"].alias("component_id"))


def op4_suffix_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_rules.judge(read_table(spark, sf_dir, "documents")).drop("n_covered", "longest")


def op5_piece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_counts.count_tokens(read_table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("piece_bpe_32k.model"), 4096)


def op6_url_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_segments.judge(read_table(spark, sf_dir, "pages")).drop("log_odds")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digests(decontaminate.contaminated(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), width=10))


def op8_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity_mil.train(docs, read_table(spark, sf_dir, "labels"), "toxic", folds=3, held_out=1)
    return toxicity_mil.predictions(toxicity_mil.score(docs, model), "doc_id", 3, 1, 0.7)


def op9_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_join.scan(read_table(spark, sf_dir, "documents"))


def op10_substring_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_blocks.remove_repeats(read_table(spark, sf_dir, "documents"), width=13)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return language_id.predictions(language_id.score(docs, language_id.train(docs, folds=4, held_out=2)), "doc_id", 4, 2)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(read_table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(read_table(spark, sf_dir, "embeddings"))
    code = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    return coded.select("vec_id", code.alias("code"), "error", "label_error",
                        F.lit(vector_codes.digest(books)).alias("codebooks_sha256"))


QUERIES = {
    "op1_bpe_tree": op1_bpe_tree,
    "op2_pairwise_quality": op2_pairwise_quality,
    "op3_simhash_grid": op3_simhash_grid,
    "op4_suffix_rules": op4_suffix_rules,
    "op5_piece_counts": op5_piece_counts,
    "op6_url_segments": op6_url_segments,
    "op7_decontaminate": op7_decontaminate,
    "op8_toxicity_mil": op8_toxicity_mil,
    "op9_license_join": op9_license_join,
    "op10_substring_blocks": op10_substring_blocks,
    "op11_language_id": op11_language_id,
    "op12_source_divergence": op12_source_divergence,
    "op13_vector_codes": op13_vector_codes,
}

ORACLE: dict[str, str] = {
    "op4_suffix_rules": suffix_rules.ORACLE_OP4,
    "op7_decontaminate": decontaminate.ORACLE_OP7,
    "op9_license_join": license_join.oracle_sql(),
    "op10_substring_blocks": substring_blocks.ORACLE_OP10,
    "op12_source_divergence": source_divergence.ORACLE_OP12,
    "op13_vector_codes": vector_codes.ORACLE_OP13,
}
