"""The corpus pipeline: quality rules, n-gram Jaccard join, substring dedup,
benchmark decontamination, BPE encoding and decoding.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which ``run`` writes to the shared folder and reads again
as the next one's docs. All stages but the last return the columns of
documents, in their order; the last returns, per document that is left, what
``bpe_round_trip`` finds and whether decoding gives the text back.

``n_chars`` follows the text where substring dedup changes it. A document of
which every word is a repeat leaves with the empty text, and stays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termcluster.llm.bpe_rounds import bpe_round_trip
from termcluster.llm.catalog import table, tokenizer_path
from termcluster.llm.mcd_quality import quality_rules
from termcluster.llm.mgo_join import component_survivors
from termcluster.llm.rlz_dedup import substring_dedup
from termcluster.llm.shared import import_in_workers, scratch
from termcluster.llm.suffix_decontamination import decontaminate


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and aren't outliers."""
    return quality_rules(docs, keep_row=True).filter("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, the one with the smallest id; of rows
    that share this id, one."""
    import_in_workers(spark)
    return component_survivors(docs, one_per_id=True)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 words that an earlier document has; the
    kept words of a changed text are joined by one space."""
    import_in_workers(spark)
    found = substring_dedup(docs, keep_row=True)
    text = F.coalesce("kept_text", "row.text")
    changed = {"text": text, "n_chars": F.when(F.col("kept_text").isNotNull(), F.char_length("kept_text").cast("long")).otherwise(F.col("row.n_chars"))}
    return found.select(*(changed.get(c, F.col(f"row.{c}")).alias(c) for c in docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark."""
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"), keep_row=True)
    return found.filter(~F.col("contaminated")).select("row.*")


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, in digest, and whether they decode to its text."""
    import_in_workers(spark)
    found = bpe_round_trip(docs, tokenizer_path("byte_bpe_50k.json"), with_ids=False, keep_row=True)
    same = F.col("decoded_sha256") == F.sha2(F.coalesce("row.text", F.lit("")).cast("binary"), 256)
    return found.select(F.col("row.doc_id").alias("doc_id"), "row.lang", "row.source", "n_tokens", "ids_sha256", same.alias("round_trip"))


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("benchmark_decontamination", decontamination),
    ("bpe_round_trip", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch(stage(spark, docs, sf_dir), name)
    return docs


# Minimum covariance determinants and token ids have no SQL; tests/llm/test_corpus_pipeline.py
# holds every stage against a plain version.
ORACLE_SQL = None
