"""Posting files: comma-separated lines without header or quoting.

Fields: posting type, id, accepted answer id, parent id, score, tag.
Fields 2 and 3 are null when empty; the tag is the sixth field when
present and non-empty; further fields are ignored. Quotes are data
(``"C++"`` keeps its quotes), which is why this is ``read.text`` +
``split`` and not the CSV reader. A non-integer in an integer field, or
fewer than five fields, fails the job.

Ids are read as ``bigint`` (the reference's 32-bit ids would overflow
on a data set of this target size); type and score stay ``int``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POSTING_SCHEMA = T.StructType([
    T.StructField("posting_type", T.IntegerType(), False),
    T.StructField("id", T.LongType(), False),
    T.StructField("accepted_answer", T.LongType(), True),
    T.StructField("parent_id", T.LongType(), True),
    T.StructField("score", T.IntegerType(), False),
    T.StructField("tag", T.StringType(), True),
])

_INT_PATTERN = r"^[+-]?[0-9]+$"


def read_posting_lines(spark: SparkSession, path: str,
                       sample_fraction: float | None = None, seed: int = 0) -> DataFrame:
    """Scan a posting file (one record per line) into ``value string``;
    with ``sample_fraction``, a with-replacement sample of the lines
    (``sample_lines``)."""
    lines = spark.read.text(path)
    if sample_fraction is not None:
        lines = sample_lines(lines, fraction=sample_fraction, seed=seed, with_replacement=True)
    return lines


def _strict_int(field: Column, type_: str, what: str) -> Column:
    """Cast a decimal string, failing the job on anything else (blanks,
    empty strings, overflow) whatever the session's ANSI setting."""
    parsed = field.try_cast(type_)
    ok = field.rlike(_INT_PATTERN) & parsed.isNotNull()
    return F.when(ok, parsed).otherwise(
        F.raise_error(F.concat(F.lit(f"bad {what} field: '"), F.coalesce(field, F.lit("<missing>")), F.lit("'"))))


def parse_postings(lines: DataFrame, value: str = "value") -> DataFrame:
    """Parse posting lines into the six typed posting columns."""
    arr = F.split(F.col(value), ",")
    # get() returns null past the end; a missing mandatory field is then
    # reported by _strict_int, a missing optional one stays null.
    f = [F.get(arr, i) for i in range(6)]
    fields = lines.select(*[x.alias(f"f{i}") for i, x in enumerate(f)])
    c = [F.col(f"f{i}") for i in range(6)]
    return fields.select(
        _strict_int(c[0], "int", "posting type").alias("posting_type"),
        _strict_int(c[1], "bigint", "id").alias("id"),
        F.when(c[2] == "", F.lit(None).cast("bigint"))
         .otherwise(_strict_int(c[2], "bigint", "accepted answer")).alias("accepted_answer"),
        F.when(c[3] == "", F.lit(None).cast("bigint"))
         .otherwise(_strict_int(c[3], "bigint", "parent id")).alias("parent_id"),
        _strict_int(c[4], "int", "score").alias("score"),
        F.nullif(c[5], F.lit("")).alias("tag"),
    )


def posting_lines(postings: DataFrame) -> DataFrame:
    """Render typed postings as lines (the inverse of ``parse_postings``;
    a posting without tag has five fields)."""
    def s(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))
    five = F.concat_ws(",", s("posting_type"), s("id"), s("accepted_answer"),
                       s("parent_id"), s("score"))
    return postings.select(
        F.when(F.col("tag").isNull(), five)
         .otherwise(F.concat(five, F.lit(","), F.col("tag"))).alias("value"))


def sample_lines(lines: DataFrame, fraction: float = 0.1, seed: int = 0,
                 with_replacement: bool = True) -> DataFrame:
    """Row sample of the source: with replacement (default), a row appears
    k times with the Poisson probability of k for the mean ``fraction``.

    Equal lines are numbered, and the draw is the md5 of seed, number and
    line: the sample is the same on any layout, and every line has a draw of
    its own. The numbers come from the lines' counts (one row a distinct line,
    pre-aggregated); a line with more than ``NUMBERS`` occurrences is dealt in
    chunks over the tasks. Other columns and null lines are dropped."""
    counted = (lines.select("value").filter(F.col("value").isNotNull())
               .groupBy("value").agg(F.count(F.lit(1)).alias("n")))
    few = counted.filter(F.col("n") <= NUMBERS).select("value", F.lit(0).cast("bigint").alias("first"), F.col("n").alias("end"))
    first = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(NUMBERS).cast("bigint"))).alias("first")
    many = (counted.filter(F.col("n") > NUMBERS).select("value", "n", first).repartition("value", "first")
            .select("value", "first", F.least(F.col("first") + NUMBERS, "n").alias("end")))
    each = few.unionByName(many).select("value", F.explode(F.sequence("first", F.col("end") - 1)).alias("k"))
    text = F.concat(F.lit(f"{int(seed)}:"), F.col("k").cast("string"), F.lit(":"), F.col("value"))
    draw = F.conv(F.substring(F.md5(text), 1, DRAW_DIGITS), 16, 10).cast("bigint")
    if not with_replacement:
        return each.filter(draw < int(fraction * 16 ** DRAW_DIGITS)).select("value")
    copies = sum((F.when(F.col("d") >= t, 1).otherwise(0) for t in poisson_thresholds(fraction)), F.lit(0))
    return each.select("value", draw.alias("d")).select(F.explode(F.array_repeat("value", copies)).alias("value"))


# Occurrences of one line that a task numbers at a time.
NUMBERS = 1 << 16
# Hex digits of a draw: exact in a bigint and in the doubles of the thresholds.
DRAW_DIGITS = 13


def poisson_thresholds(mean: float) -> list[int]:
    """A draw of at least the k-th threshold (from 0) gives more than k copies."""
    if not 0 <= mean <= 100:
        raise ValueError("sample fraction outside 0..100")
    scale, out = 16 ** DRAW_DIGITS, []
    p = total = math.exp(-mean)
    while int(total * scale) < scale and p * scale >= 1 or len(out) < mean:
        out.append(int(total * scale))
        p *= mean / len(out)
        total += p
    return out
