"""Term dictionaries: lists or tables of terms, joined to rows by their text.

A short list is best compared inside an expression. A long one becomes a table
(term, idx) that is joined: Spark builds its hash table once per task and each row
probes it once, so the cost of a row doesn't depend on the number of terms. The
table of a list is broadcast if its known size is at most ``BROADCAST_BYTES``; larger
lists, and dictionaries that are DataFrames, are left to Spark's own size check."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termcluster.params import check_terms

# Up to here an expression over the list is cheaper than a join.
SHORT_LIST = 32
# Text and row overhead of a list that is broadcast at most.
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 32

Terms = Sequence[str] | DataFrame


def is_short(terms: Terms) -> bool:
    return not isinstance(terms, DataFrame) and len(terms) <= SHORT_LIST


def checked(terms: Terms) -> Terms:
    """The list as a tuple, validated; a DataFrame as it is."""
    return terms if isinstance(terms, DataFrame) else check_terms(terms)


def is_broadcast(terms: Terms) -> bool:
    """True for lists whose table has a proven, small size."""
    return not isinstance(terms, DataFrame) and sum(len(t.encode()) + ROW_BYTES for t in terms) <= BROADCAST_BYTES


def dictionary(spark: SparkSession, terms: Terms, for_join: bool = True) -> DataFrame:
    """``(term, idx)``, one row per term, without null terms. A DataFrame of terms
    keeps its column ``idx`` if it has one; of equal terms the smallest index counts."""
    if isinstance(terms, DataFrame):
        known = terms.filter(F.col("term").isNotNull())
        if "idx" in terms.columns:
            return known.groupBy("term").agg(F.min("idx").alias("idx"))
        return known.select("term").distinct()
    terms = check_terms(terms)
    # an Arrow table becomes a local relation: no Python worker, exact size
    table = spark.createDataFrame(pa.table({"term": pa.array(terms, pa.string()), "idx": pa.array(range(len(terms)), pa.int32())}))
    return F.broadcast(table) if for_join and is_broadcast(terms) else table


def literal_strings(values: Sequence[str]) -> Column:
    """The list as one array literal, whatever its length: a constant text, split at
    a character that none of the values holds (folded once, at planning)."""
    used = set().union(*values)
    mark = next(chr(c) for c in range(1, 0xD800) if chr(c) not in used)
    return F.split(F.lit(mark.join(values)), f"\\Q{mark}\\E", -1)
