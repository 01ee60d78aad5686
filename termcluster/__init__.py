"""termcluster: term ranking and integer k-means clustering of scored
questions, written as Spark DataFrame jobs.

Subpackages
-----------
sources    line scans and parsers, mapping of the given tables
functions  Column-expression helpers (tokens, distances, labels)
operators  DataFrame -> DataFrame operators (mentions, ranking,
           postings, sampling, kmeans, report)
plans      the named query catalogue and its DuckDB oracle SQL
"""

from termcluster.params import ClusterParams

__all__ = ["ClusterParams"]
