"""Which articles mention which terms, and how many articles per term.

All operators read the text once: it is split on spaces a single time,
never re-split per term. A short term list is intersected with the words
inside the expression. A long list, or a DataFrame of terms, is a
dictionary table: the distinct words of an article probe it, so a row
costs the same for a thousand terms and for a hundred thousand. Counting is a ``groupBy(term)`` whose partial aggregate leaves at
most one row per term in every map task, so the shuffle is tiny however
large the corpus and however skewed the terms ("the" in a third of all
articles costs nothing extra).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termcluster.functions.dictionary import Terms, checked, dictionary, is_broadcast, is_short
from termcluster.functions.text import mentioned_terms, mentions, tokens
from termcluster.operators.ranks import numbered
from termcluster.session import reliable_checkpoint

# Doc ids per posting block of the inverted index: no array grows with the
# corpus, and every block of a term but its last is full.
DEFAULT_BLOCK = 1 << 16


def articles_mentioning(articles: DataFrame, term: str, text: str = "text") -> DataFrame:
    """The articles whose text mentions ``term`` as a whole word."""
    return articles.filter(mentions(text, term))


def term_occurrence_count(articles: DataFrame, term: str, text: str = "text") -> DataFrame:
    """One row ``(term, n)``: the number of articles mentioning ``term``.

    A global ``count_if``: each task counts its split, one row per task
    crosses the shuffle."""
    return articles.agg(F.count_if(mentions(text, term)).alias("n")).select(
        F.lit(term).alias("term"), F.col("n"))


def mentioned(articles: DataFrame, terms: Terms, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` and ``term``: one row per article and distinct listed term."""
    terms = checked(terms)
    if is_short(terms):
        return articles.select(*keep, F.explode(mentioned_terms(text, terms)).alias("term"))
    words = articles.select(*keep, F.explode(F.array_distinct(tokens(text))).alias("term"))
    return words.join(dictionary(articles.sparkSession, terms).select("term"), "term", "left_semi").select(*keep, "term")


def article_term_pairs(articles: DataFrame, terms: Terms, id_col: str = "doc_id",
                       text: str = "text") -> DataFrame:
    """One row ``(id_col, term)`` per article and mentioned term (the long
    form of the inverted index). An article mentioning a term several
    times gives one row; articles mentioning no term give none."""
    return mentioned(articles, terms, text, (id_col,))


def term_counts(articles: DataFrame, terms: Terms, text: str = "text") -> DataFrame:
    """``(term, n)`` for every term mentioned at least once, in one shuffle
    of pre-aggregated counts. A dictionary that isn't known to be small meets
    the counts of all words, one row a word, instead of the words themselves."""
    terms = checked(terms)
    if is_short(terms) or is_broadcast(terms):
        return mentioned(articles, terms, text).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    words = articles.select(F.explode(F.array_distinct(tokens(text))).alias("term"))
    counts = words.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(dictionary(articles.sparkSession, terms).select("term"), "term", "left_semi")


def with_rank(counts: DataFrame, bounded: bool = True) -> DataFrame:
    """Add ``rnk`` (1 = most articles; ties by term ascending).

    ``bounded``: the input has at most one row per term of a driver-held
    list, and the un-partitioned window sees at most that many rows. Else the
    rows are numbered in ranges, by many tasks."""
    order = (F.col("n").desc(), F.col("term").asc())
    counts = counts.select("term", F.col("n").cast("bigint").alias("n"))
    if bounded:
        return counts.withColumn("rnk", F.row_number().over(Window.orderBy(*order)))
    return numbered(counts, order).select("term", "n", (F.col("rn") + 1).cast("int").alias("rnk"))


def rank_terms_all(articles: DataFrame, terms: Terms, text: str = "text") -> DataFrame:
    """Ranking over every listed term, with ``n = 0`` for terms that no
    article mentions.

    The term list (one row per term, weight 0) is unioned with the
    mentions (weight 1) and one aggregate sums them: the zero rows ride
    on the same partial + final aggregate, with no join and no broadcast."""
    terms = checked(terms)
    zero = dictionary(articles.sparkSession, terms, for_join=False).select("term", F.lit(0).cast("bigint").alias("n"))
    if is_short(terms) or is_broadcast(terms):
        seen = mentioned(articles, terms, text).withColumn("n", F.lit(1).cast("bigint"))
    else:
        seen = term_counts(articles, terms, text)
    counts = zero.unionByName(seen).groupBy("term").agg(F.sum("n").alias("n"))
    return with_rank(counts, not isinstance(terms, DataFrame))


def rank_terms_grouped(articles: DataFrame, terms: Terms, text: str = "text") -> DataFrame:
    """Ranking of the mentioned terms in one shuffle (no zero rows)."""
    return with_rank(term_counts(articles, terms, text), not isinstance(terms, DataFrame))


def term_index(articles: DataFrame, terms: Terms, id_col: str = "doc_id", text: str = "text",
               block: int = DEFAULT_BLOCK) -> DataFrame:
    """Inverted index ``(term, block, docs, n)``: for each term, the sorted
    ids of the articles mentioning it, cut into blocks of ``block_size`` ids
    (``block`` counts from 0; only a term's last block may hold fewer).
    ``n = size(docs)``. Sparse ids give full blocks, and an id that many
    articles share is spread over as many blocks as its rows fill.

    The pairs (ids, never whole articles) are written once to the checkpoint
    folder and counted per term, pre-aggregated. If no term has more than one
    block, they are grouped by term. Else the pairs of the longer terms are
    numbered in ranges of (term, id) by many tasks, and the number gives the
    block."""
    if block <= 0:
        raise ValueError("block size must be positive")
    id_type = articles.schema[id_col].dataType.typeName()
    if id_type not in ("long", "integer", "short", "byte"):
        raise ValueError(f"the index blocks integral ids; {id_col!r} is {id_type} "
                         "(number the articles, e.g. with monotonically_increasing_id)")
    pairs = reliable_checkpoint(mentioned(articles, terms, text, (id_col,)).select("term", F.col(id_col).alias("doc")))
    long_terms = pairs.groupBy("term").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block).select("term")
    placed = pairs.withColumn("block", F.lit(0).cast("bigint"))
    if not long_terms.isEmpty():
        long_terms = reliable_checkpoint(long_terms)
        longer = numbered(pairs.join(long_terms, "term", "left_semi"), ("doc",), ("term",))
        placed = placed.join(long_terms, "term", "left_anti").unionByName(
            longer.select("term", "doc", F.expr(f"rn div {int(block)}").alias("block")))
    return (placed.groupBy("term", "block")
            .agg(F.array_sort(F.collect_list("doc")).alias("docs"))
            .select("term", "block", "docs", F.size("docs").cast("bigint").alias("n")))


def rank_terms_from_index(index: DataFrame, bounded: bool = True) -> DataFrame:
    """Ranking from the inverted index: the sum of the block sizes.
    ``bounded``: the terms came from a driver-held list (see ``with_rank``)."""
    return with_rank(index.groupBy("term").agg(F.sum("n").alias("n")), bounded)
