"""Mapping of the given parquet tables onto the two data models.

* articles  = ``documents`` (``title`` = ``doc_id`` as text).
* postings  = questions from ``orders`` (type 1, tag = order priority)
  union all answers from ``lineitem`` (type 2, parent = order key,
  score = whole part of the extended price).

Only column projections: the parquet scans keep predicate pushdown and
column pruning (e.g. the questions side never reads ``lineitem``).
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The terms ranked over ``documents`` (order = index).
DOCUMENT_TERMS = ("the", "The", "of", "and", "to", "in", "en", "de", "la",
                  "is", "that", "was", "with", "Java", "C++")

# The order priorities used as question tags (order = index).
PRIORITY_TAGS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")

# Answer ids are order key * 8 + line number (line numbers are 1..7).
ANSWER_ID_FACTOR = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id bigint, text string``."""
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles ``doc_id bigint, title string, text string``."""
    return documents(spark, sf_dir).select(
        "doc_id", F.col("doc_id").cast("string").alias("title"), "text")


def postings(spark: SparkSession, sf_dir: str, tag: Column | None = None) -> DataFrame:
    """Typed postings (see ``sources.postings.POSTING_SCHEMA``). ``tag``: the
    question's tag, an expression over ``orders`` (default: the order priority)."""
    questions = table(spark, sf_dir, "orders").select(
        F.lit(1).alias("posting_type"),
        F.col("o_orderkey").alias("id"),
        F.lit(None).cast("bigint").alias("accepted_answer"),
        F.lit(None).cast("bigint").alias("parent_id"),
        F.lit(0).alias("score"),
        (F.col("o_orderpriority") if tag is None else tag).alias("tag"),
    )
    answers = table(spark, sf_dir, "lineitem").select(
        F.lit(2).alias("posting_type"),
        (F.col("l_orderkey") * ANSWER_ID_FACTOR + F.col("l_linenumber")).alias("id"),
        F.lit(None).cast("bigint").alias("accepted_answer"),
        F.col("l_orderkey").alias("parent_id"),
        F.col("l_extendedprice").cast("int").alias("score"),  # truncates toward zero
        F.lit(None).cast("string").alias("tag"),
    )
    return questions.unionByName(answers)


def benchmark_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of the benchmark texts as a dictionary table ``(term)``."""
    words = table(spark, sf_dir, "benchmark").select(F.explode(F.split("text", " ")).alias("term"))
    return words.filter(F.col("term") != "").distinct()


def customer_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same postings, with the ordering customer as the question's tag."""
    return postings(spark, sf_dir, F.concat(F.lit("C"), F.col("o_custkey")))


def building_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers of one market segment as a dictionary table ``(term, idx)``."""
    customer = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    return customer.select(F.concat(F.lit("C"), F.col("c_custkey")).alias("term"), F.col("c_custkey").alias("idx"))


def priority_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One question per order priority, whose answers are the orders: few groups,
    each of a share of all rows."""
    orders = table(spark, sf_dir, "orders")
    question = F.ascii("o_orderpriority").cast("bigint")
    answers = orders.select(
        F.lit(2).alias("posting_type"), F.col("o_orderkey").alias("id"), F.lit(None).cast("bigint").alias("accepted_answer"),
        question.alias("parent_id"), F.col("o_totalprice").cast("int").alias("score"), F.lit(None).cast("string").alias("tag"))
    questions = orders.select(
        F.lit(1).alias("posting_type"), question.alias("id"), F.lit(None).cast("bigint").alias("accepted_answer"),
        F.lit(None).cast("bigint").alias("parent_id"), F.lit(0).alias("score"), F.col("o_orderpriority").alias("tag")).distinct()
    return questions.unionByName(answers)
