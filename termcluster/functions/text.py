"""Whole-word term matching as Column expressions.

A document mentions a term when one of the pieces of its text, split on
single spaces, equals the term exactly (case-sensitive). ``Java,`` and a
word after a newline therefore do not count as ``Java``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from termcluster.params import check_terms


def tokens(text: Column | str) -> Column:
    """The text split on single spaces (a literal one-character pattern)."""
    return F.split(_col(text), " ")


def term_array(terms) -> Column:
    """The term list as an array literal; its order is the term index."""
    return F.array(*[F.lit(t) for t in check_terms(terms)])


def mentions(text: Column | str, term: str) -> Column:
    """True when ``text`` contains ``term`` as a whole space-separated word."""
    check_terms([term])
    return F.array_contains(tokens(text), F.lit(term))


def mentioned_terms(text: Column | str, terms) -> Column:
    """The distinct terms of a short list that ``text`` mentions.

    The text is split once and intersected with the list, whose hash set is
    built for every row: long lists go through
    ``operators.mentions.mentioned``. A term repeated in the text is
    reported once."""
    return F.array_intersect(tokens(text), term_array(terms))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
