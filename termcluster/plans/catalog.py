"""Named queries over the given tables: ``name -> f(spark, sf_dir)``.

Every query reads the given parquet tables (or data Spark derives from
them) in full; nothing is capped, sampled or filtered to an id subset
except where sampling is the operator itself.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from termcluster.operators import kmeans as km
from termcluster.operators import mentions
from termcluster.operators import postings as post
from termcluster.operators import report as rep
from termcluster.operators import sampling
from termcluster.operators.clustering import Clustering, cluster_questions, prepare
from termcluster.params import ClusterParams
from termcluster.session import reliable_checkpoint
from termcluster.sources import articles as article_src
from termcluster.sources import postings as posting_src
from termcluster.sources import tables
from termcluster.sources.tables import DOCUMENT_TERMS, PRIORITY_TAGS

QueryFn = Callable[[SparkSession, str], DataFrame]

# The single term of the one-term queries.
ONE_TERM = "the"

# The sampled share of the posting lines.
SAMPLE_FRACTION = 0.1
SAMPLE_SEED = 0

# Blocks and parts of the queries that show their splitting, and the size of
# the large sample.
SMALL_BLOCK = 64
LARGE_SAMPLE = 5000

# Clustering of the order/line-item postings: 5 priority strata, three
# centres each. With spread 50000 every cluster of this data is pure, so
# the "_mixed" queries rerun with spread 5000 to exercise the dominance
# and share computation on mixed clusters.
POSTING_PARAMS = ClusterParams(terms=PRIORITY_TAGS, spread=50000, kernels=15,
                               eta=20.0, max_iterations=120, seed=42)
MIXED_PARAMS = replace(POSTING_PARAMS, spread=5000)


def article_lines_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Render every document as a dump line and parse it back."""
    lines = article_src.article_lines(tables.articles(spark, sf_dir))
    return article_src.parse_articles(lines)


def articles_mentioning_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.articles_mentioning(tables.articles(spark, sf_dir), ONE_TERM).select("doc_id")


def term_occurrence_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.term_occurrence_count(tables.articles(spark, sf_dir), ONE_TERM)


def article_term_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.article_term_pairs(tables.articles(spark, sf_dir), DOCUMENT_TERMS)


def rank_terms_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.rank_terms_all(tables.articles(spark, sf_dir), DOCUMENT_TERMS)


def term_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.term_index(tables.articles(spark, sf_dir), DOCUMENT_TERMS)


def rank_terms_from_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.rank_terms_from_index(term_index(spark, sf_dir))


def rank_terms_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.rank_terms_grouped(tables.articles(spark, sf_dir), DOCUMENT_TERMS)


def article_term_pairs_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs for a dictionary table: all words of the benchmark texts."""
    return mentions.article_term_pairs(tables.articles(spark, sf_dir), tables.benchmark_words(spark, sf_dir))


def rank_terms_all_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.rank_terms_all(tables.articles(spark, sf_dir), tables.benchmark_words(spark, sf_dir))


def term_index_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index for a dictionary table, in small blocks, so that terms have many."""
    return mentions.term_index(tables.articles(spark, sf_dir), tables.benchmark_words(spark, sf_dir), block=SMALL_BLOCK)


def posting_lines_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Render every posting as a line and parse it back."""
    return posting_src.parse_postings(posting_src.posting_lines(tables.postings(spark, sf_dir)))


def lines_sample_with_replacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = posting_src.posting_lines(tables.postings(spark, sf_dir))
    return posting_src.sample_lines(lines, fraction=SAMPLE_FRACTION, seed=SAMPLE_SEED)


def questions_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return post.questions(tables.postings(spark, sf_dir))


def answers_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return post.answers(tables.postings(spark, sf_dir))


def question_answer_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return post.question_answer_pairs(tables.postings(spark, sf_dir))


def question_answer_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return post.question_answer_groups(tables.postings(spark, sf_dir))


def question_max_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return post.question_max_score(tables.postings(spark, sf_dir))


def question_tag_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = post.question_max_score(tables.postings(spark, sf_dir))
    return post.question_tag_index(scored, POSTING_PARAMS.terms)


def question_tag_index_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags are customers; the dictionary is a table of customers."""
    scored = post.question_max_score(tables.customer_postings(spark, sf_dir))
    return post.question_tag_index(scored, tables.building_customers(spark, sf_dir))


def score_vectors_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return post.score_vectors(tables.customer_postings(spark, sf_dir), tables.building_customers(spark, sf_dir), POSTING_PARAMS.spread)


def question_answer_groups_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers grouped per tag instead of per question, in small parts: every group
    has many."""
    return post.question_answer_groups(tables.priority_postings(spark, sf_dir), part=SMALL_BLOCK)


def _vectors(spark: SparkSession, sf_dir: str, params: ClusterParams = POSTING_PARAMS) -> DataFrame:
    return post.score_vectors(tables.postings(spark, sf_dir), params.terms, params.spread)


def score_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vectors(spark, sf_dir)


def score_vectors_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = POSTING_PARAMS
    return post.score_vectors(tables.postings(spark, sf_dir), p.terms, p.spread, sort=True)


def sample_per_stratum(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = POSTING_PARAMS
    return sampling.sample_per_stratum(_vectors(spark, sf_dir), p.per_stratum, p.seed).select("x", "y", "id")


def sample_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = POSTING_PARAMS
    return sampling.sample_global(_vectors(spark, sf_dir), p.kernels, p.seed).select("x", "y", "id")


def sample_global_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample that no task holds: by the histogram of keys."""
    return sampling.sample_global(_vectors(spark, sf_dir), LARGE_SAMPLE, POSTING_PARAMS.seed, one_task=SMALL_BLOCK).select("x", "y", "id")


def _prepared(spark: SparkSession, sf_dir: str, params: ClusterParams = POSTING_PARAMS) -> Clustering:
    """Weighted points in the checkpoint folder, their lines and the stratified
    initial centres; the tables are read once and nothing stays cached."""
    return prepare(tables.postings(spark, sf_dir), params)


def assign_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = POSTING_PARAMS
    vectors = reliable_checkpoint(_vectors(spark, sf_dir))
    centres = sampling.initial_centres(vectors, p.kernels, p.per_stratum, p.seed)
    return km.assign_nearest(vectors, centres).select("id", "x", "y", "cluster")


def cluster_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _prepared(spark, sf_dir)
    return km.cluster_means(c.points, c.initial, c.lines)


def cluster_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _prepared(spark, sf_dir)
    return rep.cluster_sizes(c.points, c.initial, c.lines)


def centre_movement(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _prepared(spark, sf_dir)
    return km.centre_movement(km.centres_frame(spark, c.initial), km.cluster_means(c.points, c.initial, c.lines))


def kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = cluster_questions(tables.postings(spark, sf_dir), POSTING_PARAMS)
    return run.result.frame(spark)


def _dominant(spark: SparkSession, sf_dir: str, params: ClusterParams) -> DataFrame:
    c = _prepared(spark, sf_dir, params)
    return rep.cluster_dominant(c.points, c.initial, params.terms, params.spread, c.lines)


def cluster_dominant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dominant(spark, sf_dir, POSTING_PARAMS)


def cluster_dominant_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dominant(spark, sf_dir, MIXED_PARAMS)


def cluster_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _prepared(spark, sf_dir)
    return rep.cluster_median(c.points, c.initial, c.lines)


def cluster_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_questions(tables.postings(spark, sf_dir), POSTING_PARAMS).report()


def cluster_report_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_questions(tables.postings(spark, sf_dir), MIXED_PARAMS).report()


def cluster_report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rep.report_lines(cluster_report(spark, sf_dir))


QUERIES: dict[str, QueryFn] = {
    "article_lines_parse": article_lines_parse,
    "articles_mentioning_term": articles_mentioning_term,
    "term_occurrence_count": term_occurrence_count,
    "article_term_pairs": article_term_pairs,
    "rank_terms_all": rank_terms_all,
    "term_index": term_index,
    "rank_terms_from_index": rank_terms_from_index,
    "rank_terms_grouped": rank_terms_grouped,
    "article_term_pairs_long": article_term_pairs_long,
    "rank_terms_all_long": rank_terms_all_long,
    "term_index_long": term_index_long,
    "posting_lines_parse": posting_lines_parse,
    "lines_sample_with_replacement": lines_sample_with_replacement,
    "questions_keyed": questions_keyed,
    "answers_keyed": answers_keyed,
    "question_answer_pairs": question_answer_pairs,
    "question_answer_groups": question_answer_groups,
    "question_max_score": question_max_score,
    "question_tag_index": question_tag_index,
    "question_tag_index_long": question_tag_index_long,
    "question_answer_groups_split": question_answer_groups_split,
    "score_vectors": score_vectors,
    "score_vectors_long": score_vectors_long,
    "score_vectors_sorted": score_vectors_sorted,
    "sample_per_stratum": sample_per_stratum,
    "sample_global": sample_global,
    "sample_global_large": sample_global_large,
    "assign_nearest": assign_nearest,
    "cluster_means": cluster_means,
    "cluster_sizes": cluster_sizes,
    "centre_movement": centre_movement,
    "kmeans": kmeans,
    "cluster_dominant": cluster_dominant,
    "cluster_dominant_mixed": cluster_dominant_mixed,
    "cluster_median": cluster_median,
    "cluster_report": cluster_report,
    "cluster_report_mixed": cluster_report_mixed,
    "cluster_report_text": cluster_report_text,
}

# Query run by the driver's smoke check.
FLAGSHIP = "cluster_report"
