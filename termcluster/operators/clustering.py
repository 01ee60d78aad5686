"""Question clustering end to end: vectors -> centres -> k-means -> report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from termcluster.functions.intervals import Lines
from termcluster.operators import kmeans as km
from termcluster.operators import report as rep
from termcluster.operators.postings import score_vectors
from termcluster.operators.sampling import initial_centres
from termcluster.params import ClusterParams


@dataclass
class Clustering:
    """The state of one clustering run.

    ``points`` are the weighted points in the shared checkpoint folder and
    ``lines`` their x with the ends and bands of each; ``initial`` the sampled
    centres; ``result`` the k-means outcome."""

    params: ClusterParams
    points: DataFrame
    lines: Lines | None
    initial: km.Centres
    result: km.KMeansResult | None = None

    def report(self) -> DataFrame:
        return rep.cluster_report(self.points, self.final_centres, self.params.terms,
                                  self.params.spread, lines=self.lines)

    @property
    def final_centres(self) -> km.Centres:
        if self.result is None:
            raise RuntimeError("k-means has not run")
        return self.result.centres


def prepare(postings: DataFrame, params: ClusterParams) -> Clustering:
    """Vectors, initial centres and checkpointed weighted points.

    The vectors feed two jobs (the sample and the point aggregate), so
    they are persisted for the duration; the points that the k-means
    steps read lie in the checkpoint folder."""
    per_stratum = params.per_stratum       # raises unless kernels is a multiple of the terms
    if not params.samples_by_stratum:
        per_stratum = None                 # strata too close: one global sample
    vectors = score_vectors(postings, params.terms, params.spread).persist(
        StorageLevel.MEMORY_AND_DISK_DESER)
    try:
        centres = initial_centres(vectors, params.kernels, per_stratum, params.seed)
        points, lines = km.banded_points(vectors)
    finally:
        vectors.unpersist()
    return Clustering(params, points, lines, centres)


def cluster_questions(postings: DataFrame, params: ClusterParams) -> Clustering:
    """Prepare and run k-means to convergence (or the iteration cap, see
    ``result.converged``)."""
    c = prepare(postings, params)
    c.result = km.kmeans(c.points, c.initial, params.eta, params.max_iterations, c.lines)
    return c
