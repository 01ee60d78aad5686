"""Per-cluster report: dominant term, its share, size and median score.

All of it is aggregation over the (weighted) points assigned to the
final centres: the dominant x is the maximum of ``(count, x)`` structs
per cluster (ties go to the larger x), the size a sum of weights and
the median an exact rank search, truncated toward zero (an even-sized
cluster takes half the sum of its middle values). No buffer holds a
cluster's members or its distinct scores: the search adds up the weights
of score buckets, and looks only into those that hold a middle rank.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termcluster.functions.geometry import term_label
from termcluster.functions.intervals import Lines
from termcluster.operators.kmeans import assign_nearest, point_weight

# The printed report line (median, label, percent, size)
# and the three header lines printed above it.
REPORT_FORMAT = "%7d  %-17s (%-5.1f%%)      %7d"
REPORT_HEADER = (
    "Resulting clusters:",
    "  Score  Dominant language (%percent)  Questions",
    "================================================",
)


# A bucket holds 2^16 scores, so a cluster of 32-bit scores has at most 2^16 buckets.
BUCKET_BITS = 16


def _assigned(points: DataFrame, centres, lines: Lines | None = None) -> DataFrame:
    return assign_nearest(points, centres, lines).select("cluster", "x", "y", point_weight(points).alias("w"))


def cluster_sizes(points: DataFrame, centres: Sequence[tuple[int, int]], lines: Lines | None = None) -> DataFrame:
    """``(cluster, size)`` for every non-empty cluster."""
    return _assigned(points, centres, lines).groupBy("cluster").agg(F.sum("w").alias("size"))


def _dominant(assigned: DataFrame, terms, spread: int) -> DataFrame:
    per_x = assigned.groupBy("cluster", "x").agg(F.sum("w").alias("n"))
    top = per_x.groupBy("cluster").agg(F.max(F.struct("n", "x")).alias("top"),
                                       F.sum("n").alias("size"))
    flat = top.select("cluster", F.col("top.n").alias("top_n"), F.col("top.x").alias("top_x"), "size")
    return flat.select(
        "cluster",
        term_label("top_x", spread, terms).alias("label"),
        (F.lit(100.0) * F.col("top_n") / F.col("size")).alias("percent"),
        F.col("size").cast("bigint").alias("size"))


def cluster_dominant(points: DataFrame, centres, terms, spread: int, lines: Lines | None = None) -> DataFrame:
    """``(cluster, label, percent)``: the most frequent stratum of each
    cluster and its share of the cluster in percent."""
    return _dominant(_assigned(points, centres, lines), terms, spread).select("cluster", "label", "percent")


def _median(assigned: DataFrame) -> DataFrame:
    """``(cluster, median)``. Ranks count from 0; the middle ones are
    ``lo`` and ``hi``, the same for odd sizes. The windows see one row per
    bucket of a cluster, then one row per score of the chosen buckets (at
    most two a cluster, so their broadcast holds at most 2 K rows)."""
    scores = (assigned.groupBy("cluster", F.col("y").cast("bigint").alias("y")).agg(F.sum("w").alias("w"))
              .withColumn("bucket", F.shiftright("y", BUCKET_BITS)))
    cluster = Window.partitionBy("cluster")
    before = F.sum("w").over(cluster.orderBy("bucket")) - F.col("w")
    total = F.sum("w").over(cluster)
    chosen = (scores.groupBy("cluster", "bucket").agg(F.sum("w").alias("w"))
              .select("cluster", "bucket", "w", before.alias("before"), total.alias("total"))
              .selectExpr("cluster", "bucket", "w", "before", "(total - 1) div 2 AS lo", "total div 2 AS hi")
              .filter("before <= hi AND before + w > lo").drop("w"))
    inside = Window.partitionBy("cluster", "bucket").orderBy("y")
    ranked = (scores.join(F.broadcast(chosen), ["cluster", "bucket"])
              .withColumn("end", F.col("before") + F.sum("w").over(inside)))
    held = {r: F.max(F.when((F.col("end") > F.col(r)) & (F.col("end") - F.col("w") <= F.col(r)), F.col("y")))
            for r in ("lo", "hi")}
    return (ranked.groupBy("cluster").agg(*(c.alias(r) for r, c in held.items()))
            .selectExpr("cluster", "int((lo + hi) div 2) AS median"))


def cluster_median(points: DataFrame, centres, lines: Lines | None = None) -> DataFrame:
    """``(cluster, median)``: median score of all members, truncated."""
    return _median(_assigned(points, centres, lines))


def cluster_report(points: DataFrame, centres, terms, spread: int,
                   with_cluster: bool = False, lines: Lines | None = None) -> DataFrame:
    """``(label, percent, size, median)`` per non-empty cluster, ordered
    by median (then label). Both joined sides hold at most K rows."""
    # Grouped once, so that both branches reuse one exchange and the
    # nearest centres are computed once.
    assigned = _assigned(points, centres, lines).groupBy("cluster", "x", "y").agg(F.sum("w").alias("w"))
    rep = _dominant(assigned, terms, spread).join(F.broadcast(_median(assigned)), "cluster")
    cols = (["cluster"] if with_cluster else []) + ["label", "percent", "size", "median"]
    # At most K rows: one partition sorted in place gives the total order
    # without the sampling job of a range-partitioned global sort.
    return rep.select(*cols).coalesce(1).sortWithinPartitions("median", "label", "percent", "size")


def report_lines(report: DataFrame) -> DataFrame:
    """The report as printed text lines, ``line string``, in report order."""
    return (report.select(
        F.format_string(REPORT_FORMAT, "median", "label", "percent", "size").alias("line"),
        "median", "label")
        .coalesce(1).sortWithinPartitions("median", "label").select("line"))


def print_report(report: DataFrame, out=print) -> None:
    """Console sink: the header lines, then one formatted line per cluster
    in report order. Collects the report, which has at most K rows."""
    for line in REPORT_HEADER:
        out(line)
    for row in report_lines(report).collect():
        out(row["line"])
