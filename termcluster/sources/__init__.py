"""Sources: line scans and parsers, and the mapping of the given tables."""

from termcluster.sources.articles import article_lines, parse_articles, read_article_lines
from termcluster.sources.postings import (POSTING_SCHEMA, parse_postings, posting_lines,
                                          read_posting_lines, sample_lines)

__all__ = [
    "POSTING_SCHEMA", "article_lines", "parse_articles", "parse_postings",
    "posting_lines", "read_article_lines", "read_posting_lines", "sample_lines",
]
