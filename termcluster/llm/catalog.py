"""Registered queries of the subpackage and their DuckDB SQL.

``DECLARED`` maps a query name to its function; every one reads whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termcluster.llm import chain_toxicity, oracle, zstd_quality
from termcluster.llm.bpe_rounds import bpe_round_trip
from termcluster.llm.collocations import collocations
from termcluster.llm.edit_counts import edited_counts, line_edits
from termcluster.llm.mcd_quality import quality_rules
from termcluster.llm.mgo_join import jaccard_components
from termcluster.llm.rlz_dedup import substring_dedup
from termcluster.llm.rns_negatives import hard_negatives
from termcluster.llm.sais_dedup import byte_dedup
from termcluster.llm.shared import import_in_workers
from termcluster.llm.streamvbyte_output import token_id_round_trip
from termcluster.llm.suffix_decontamination import decontaminate, items_digest
from termcluster.llm.training_sample import held_out
from termcluster.llm.warc_members import warc_round_trip


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    import_in_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mgo_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op2_rlz_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(table(spark, sf_dir, "documents"), with_text=False)
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def op3_mcd_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_sais_byte_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_dedup(table(spark, sf_dir, "documents"), with_text=False).withColumnRenamed("id", "doc_id")


def op5_streamvbyte_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_id_round_trip(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json")).withColumnRenamed("id", "doc_id")


def op6_edit_aware_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts before and after removing lines that repeat the line above."""
    docs = table(spark, sf_dir, "documents")
    found = edited_counts(docs, line_edits(F.col("text")), tokenizer_path("byte_bpe_50k.tiktoken"), with_tree=False)
    return found.withColumnRenamed("id", "doc_id")


def op7_chain_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = chain_toxicity.score(docs, chain_toxicity.fit(docs, table(spark, sf_dir, "labels")))
    probabilities = (F.col(c).alias(f"p_{c}") for c in chain_toxicity.CATEGORIES)
    return scored.select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"), *probabilities, (F.col("toxic") >= 0.5).cast("int").alias("toxic"))


def op8_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        items_digest(F.col("items")).alias("items_sha256"), "contaminated")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op9_zstd_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = zstd_quality.score(docs, zstd_quality.fit(docs, table(spark, sf_dir, "labels"), label_col="quality"))
    return scored.select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "score", "predicted")


def op10_bpe_merge_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), with_ids=False).withColumnRenamed("id", "doc_id")


def op11_warc_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_misra_gries_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_rns_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh row carries a wrong label, by rule, as label noise."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", "embedding", label.alias("label")), "id % 100 = 0")


QUERIES = {
    "op1_mgo_jaccard_join": op1_mgo_jaccard_join,
    "op2_rlz_substring_dedup": op2_rlz_substring_dedup,
    "op3_mcd_quality_rules": op3_mcd_quality_rules,
    "op4_sais_byte_dedup": op4_sais_byte_dedup,
    "op5_streamvbyte_token_ids": op5_streamvbyte_token_ids,
    "op6_edit_aware_counts": op6_edit_aware_counts,
    "op7_chain_toxicity": op7_chain_toxicity,
    "op8_suffix_decontamination": op8_suffix_decontamination,
    "op9_zstd_quality_classifier": op9_zstd_quality_classifier,
    "op10_bpe_merge_rounds": op10_bpe_merge_rounds,
    "op11_warc_members": op11_warc_members,
    "op12_misra_gries_collocations": op12_misra_gries_collocations,
    "op13_rns_negatives": op13_rns_negatives,
}

ORACLE = {
    "op1_mgo_jaccard_join": oracle.JACCARD_COMPONENTS,
    "op2_rlz_substring_dedup": oracle.SUBSTRING_DEDUP,
    "op8_suffix_decontamination": oracle.DECONTAMINATION,
    "op11_warc_members": oracle.WARC_RECORDS,
    "op12_misra_gries_collocations": oracle.COLLOCATIONS,
    "op13_rns_negatives": oracle.HARD_NEGATIVES,
}
