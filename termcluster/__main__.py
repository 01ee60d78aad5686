"""Command line: the two batch programs over text files.

    python -m termcluster rank ARTICLE_LINES [--terms T ...]
    python -m termcluster cluster POSTING_LINES [--spread N] [--kernels K] ...

Both read one record per text line (``spark.read.text``) through the
strict line parsers, run on the session's cluster (``spark-submit`` or a
local master), and print results that hold at most one row per term or
per cluster.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from termcluster.operators import clustering, mentions
from termcluster.operators.report import print_report
from termcluster.params import (DEFAULT_ETA, DEFAULT_KERNELS, DEFAULT_MAX_ITERATIONS, DEFAULT_SEED,
                                DEFAULT_SPREAD, LANGUAGES, ClusterParams)
from termcluster.sources import articles as article_src
from termcluster.sources import postings as posting_src


def _ranking(df) -> list[tuple[str, int]]:
    return [(r["term"], r["n"]) for r in df.orderBy("rnk").collect()]


def rank(spark: SparkSession, path: str, terms, head: int = article_src.HEAD,
         tail: int = article_src.TAIL, out=print) -> dict[str, list[tuple[str, int]]]:
    """The three rankings of ``terms`` over an article dump."""
    lines = article_src.read_article_lines(spark, path)
    # Titles are text; the index blocks integral ids, so number the articles.
    articles = (article_src.parse_articles(lines, head=head, tail=tail)
                .withColumn("doc_id", F.monotonically_increasing_id()))
    result = {
        "separate counts": _ranking(mentions.rank_terms_all(articles, terms)),
        "inverted index": _ranking(mentions.rank_terms_from_index(
            mentions.term_index(articles, terms))),
        "one shuffle": _ranking(mentions.rank_terms_grouped(articles, terms)),
    }
    for name, ranking in result.items():
        out(f"{name}: {ranking}")
    return result


def cluster(spark: SparkSession, path: str, params: ClusterParams,
            sample_fraction: float | None = None, out=print) -> clustering.Clustering:
    """k-means over a posting file, then the printed cluster report."""
    lines = posting_src.read_posting_lines(spark, path, sample_fraction=sample_fraction)
    run = clustering.cluster_questions(posting_src.parse_postings(lines), params)
    out(f"k-means: {run.result.iterations} iterations, final movement {run.result.movement}")
    print_report(run.report(), out)
    return run


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="termcluster")
    sub = parser.add_subparsers(dest="command", required=True)
    r = sub.add_parser("rank", help="rank terms by the articles that mention them")
    r.add_argument("path")
    r.add_argument("--terms", nargs="+", default=list(LANGUAGES))
    r.add_argument("--head", type=int, default=article_src.HEAD)
    r.add_argument("--tail", type=int, default=article_src.TAIL)
    c = sub.add_parser("cluster", help="cluster questions by tag and best answer score")
    c.add_argument("path")
    c.add_argument("--terms", nargs="+", default=list(LANGUAGES))
    c.add_argument("--spread", type=int, default=DEFAULT_SPREAD)
    c.add_argument("--kernels", type=int, default=DEFAULT_KERNELS)
    c.add_argument("--eta", type=float, default=DEFAULT_ETA)
    c.add_argument("--max-iterations", type=int, default=DEFAULT_MAX_ITERATIONS)
    c.add_argument("--seed", type=int, default=DEFAULT_SEED)
    c.add_argument("--sample-fraction", type=float, default=None)
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName(f"termcluster-{args.command}").getOrCreate()
    if args.command == "rank":
        rank(spark, args.path, args.terms, args.head, args.tail)
    else:
        params = ClusterParams(terms=tuple(args.terms), spread=args.spread, kernels=args.kernels,
                               eta=args.eta, max_iterations=args.max_iterations, seed=args.seed)
        cluster(spark, args.path, params, args.sample_fraction)
    return 0


if __name__ == "__main__":
    sys.exit(main())
