"""Article dumps: one article per text line.

A line is ``<head><title></title><text><text><tail>``: the title runs
from a fixed number of leading characters (``head``, 14) up to the first
``</title><text>`` marker, the text from after the marker up to a fixed
number of trailing characters (``tail``, 16). The wrapper characters are
never inspected. A line without the marker, or too short for the cuts,
fails the job (``raise_error``), as a malformed dump should.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The marker between title and text and the default cut
# widths of the article line format.
MARKER = "</title><text>"
HEAD = 14
TAIL = 16


def read_article_lines(spark: SparkSession, path: str) -> DataFrame:
    """Scan a text dump (one record per line) into ``value string``."""
    return spark.read.text(path)


def parse_articles(lines: DataFrame, value: str = "value", head: int = HEAD,
                   tail: int = TAIL) -> DataFrame:
    """Parse article lines into ``title string, text string``.

    Pure Column expressions: ``instr`` finds the marker (1-based, 0 when
    absent) and two ``substring`` calls cut the fields, so parsing stays
    inside whole-stage codegen and scales with the scan."""
    located = lines.select(F.col(value).alias("_line"),
                           F.instr(F.col(value), MARKER).alias("_pos"))
    line, pos = F.col("_line"), F.col("_pos")          # pos is 1-based, 0 = none
    text_start = pos + len(MARKER)                        # 1-based
    text_len = F.length(line) - tail - (text_start - 1)
    malformed = (pos == 0) | (pos - 1 < head) | (text_len < 0)
    error = F.raise_error(F.concat(F.lit("malformed article line: "), F.substring(line, 1, 80)))
    return located.select(
        F.when(malformed, error).otherwise(line.substr(F.lit(head + 1), pos - 1 - head)).alias("title"),
        F.when(malformed, error).otherwise(line.substr(text_start, text_len)).alias("text"),
    )


def article_lines(articles: DataFrame, title: str = "title", text: str = "text",
                  head: str = "<page> <title>", tail: str = "</text> </page> ") -> DataFrame:
    """Render ``(title, text)`` rows as dump lines (inverse of the parser
    for a wrapper of ``len(head)`` and ``len(tail)`` characters)."""
    return articles.select(
        F.concat(F.lit(head), F.col(title), F.lit(MARKER), F.col(text), F.lit(tail)).alias("value"))
