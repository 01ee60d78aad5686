"""Integer k-means with a total-movement stop rule.

One step: assign every point to its nearest centre (squared distance,
lowest index on ties), average each cluster with integer division
truncating toward zero, and keep the old centre of a cluster that got
no point. Stop when the summed squared movement of all centres is below
``eta``, or after ``max_iterations`` steps. MLlib's KMeans is not a
substitute: it averages in floating point and stops on another rule.

Execution plan:

* Points are collapsed once into weighted distinct points ``(x, y, w)``
  (a partial + final aggregate). Sums, counts, modes and the weighted
  median are exact on them, and their number is bounded by the distinct
  (stratum, score) pairs, not by the number of questions.
* The points lie on few lines (one x per term). On a line every centre is
  nearest on one interval of y (``functions.intervals``), so a step computes
  no distances: points join the intervals that overlap their cell of y.
* The first step adds up all points. A later one takes only the intervals
  that changed hands: the points in them leave one cluster and join another,
  and the driver, which holds K sums, moves these amounts. Sums are exact
  integers, so the centres are the same as from adding up everything.
* The weighted points are written to the shared checkpoint folder in bands
  of a line, one folder each. A step reads the bands in which an interval
  moved (partition pruning), and a lost executor reads them again.
* A step is at most one job, whose partial aggregate sends at most one row per
  moved interval and task through the shuffle. Borders move less from step to
  step: once few points move, the driver fetches those near the borders (at
  most ``WINDOW_POINTS``), and steps that stay among them need no job.

Points on more than ``MAX_LINES`` different x take the way of K distances per
point (``functions.geometry.with_nearest_centre``), with the same results.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termcluster.functions.frames import literal_frame
from termcluster.functions.geometry import squared_distance, with_nearest_centre
from termcluster.functions.intervals import (Line, Lines, Voronoi, band_intervals, cell_bits, interval_table,
                                             Window, around_borders, join_intervals, with_bands)
from termcluster.session import checkpoint_dir, reliable_checkpoint

Centres = list[tuple[int, int]]


def weighted_points(vectors: DataFrame) -> DataFrame:
    """``(x, y, w)``: distinct points with their multiplicity."""
    return vectors.groupBy("x", "y").agg(F.count(F.lit(1)).alias("w"))


# Weighted points per task of a k-means step.
POINTS_PER_TASK = 10_000
# Different x up to which points are taken as lines, and bands of all lines.
MAX_LINES = 1 << 16
MAX_BANDS = 256
# Low bits that are summed apart, so that sums of 64 bits can't overflow.
LOW_BITS = 16
# Points near the borders that the driver holds at most, and how many times the last
# movement of a line's borders it expects them to move yet.
WINDOW_POINTS = 1 << 16
AHEAD = 4


def lines_of(points: DataFrame) -> Lines | None:
    """The lines of the points, one aggregate over x; None if there are more than
    ``MAX_LINES``."""
    y = F.col("y").cast("bigint")
    found = (points.groupBy(F.col("x").cast("bigint").alias("x"))
             .agg(F.min(y).alias("least"), F.max(y).alias("most"), F.count(F.lit(1)).alias("n"))
             .limit(MAX_LINES + 1).collect())
    if len(found) > MAX_LINES:
        return None
    return {r["x"]: Line(r["least"], r["most"], r["n"]) for r in found}


def banded_points(vectors: DataFrame, points_per_task: int = POINTS_PER_TASK) -> tuple[DataFrame, Lines | None]:
    """Weighted points in the shared checkpoint folder, and their lines.

    They are written by bands (``band`` is the partition column), so that a step can
    leave out those that it doesn't need: bands of about ``points_per_task`` points, at
    most 2 * ``MAX_BANDS`` and one more per line, whatever the cores and the settings."""
    spark = vectors.sparkSession
    points = weighted_points(vectors).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    try:
        lines = lines_of(points)
        if not lines:
            return checkpointed_points(vectors, points_per_task), lines
        lines = with_bands(lines, max(points_per_task, -(-sum(x.count for x in lines.values()) // MAX_BANDS)))
        bits = cell_bits(lines)
        table = interval_table(spark, band_intervals(lines), bits, ["band"])
        path = f"{checkpoint_dir(spark)}/points-{uuid.uuid4().hex}"
        bands = 1 + max(x.band_of(x.most) for x in lines.values())
        dealt = join_intervals(points, table, bits).repartition(bands, "band")
        dealt.write.partitionBy("band").parquet(path)
    finally:
        points.unpersist()
    schema = dealt.select("x", "y", "w", F.col("band").cast("int")).schema
    return spark.read.schema(schema).parquet(path), lines


def checkpointed_points(vectors: DataFrame, points_per_task: int = POINTS_PER_TASK) -> DataFrame:
    """Weighted points in the shared checkpoint folder, spread by their (distinct)
    position over ``ceil(count / points_per_task)`` partitions: for points that don't
    lie on lines."""
    points = weighted_points(vectors).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    try:
        parts = max(1, math.ceil(points.count() / max(1, points_per_task)))
        return reliable_checkpoint(points.repartition(parts, "x", "y"))
    finally:
        points.unpersist()


def point_weight(points: DataFrame):
    """The weight column of ``points``: ``w`` when present, else 1."""
    return F.col("w") if "w" in points.columns else F.lit(1).cast("bigint")


def assign_nearest(points: DataFrame, centres: Sequence[tuple[int, int]], lines: Lines | None = None) -> DataFrame:
    """``points`` plus ``cluster``, the index of the nearest centre. ``lines``: those of
    the points, if they are known."""
    lines = lines or lines_of(points)
    if not lines:
        return with_nearest_centre(points, list(centres))
    bits = cell_bits(lines)
    table = interval_table(points.sparkSession, Voronoi(list(centres), lines).all(), bits, ["cluster"])
    return join_intervals(points, table, bits).select(*points.columns, F.col("cluster").cast("int").alias("cluster"))


def split_sum(value: str, w: str) -> tuple:
    """The two sums that make up sum(value * w): of the high and of the low bits."""
    return F.expr(f"sum(shiftright({value}, {LOW_BITS}) * {w})"), F.expr(f"sum(({value} & {(1 << LOW_BITS) - 1}L) * {w})")


def step_means(points: DataFrame, centres: Sequence[tuple[int, int]], lines: Lines | None = None) -> DataFrame:
    """``(cluster, x, y, n)`` for the non-empty clusters of one step:
    truncated integer means and sizes.

    Coordinates are summed in two halves and put together as decimals, so a
    sum may pass 64 bits (sizes up to 2**46 and coordinates of 33 bits are
    exact)."""
    w = point_weight(points).cast("bigint").alias("w")
    assigned = assign_nearest(points, centres, lines).select("cluster", F.col("x").cast("bigint").alias("x"), F.col("y").cast("bigint").alias("y"), w)
    (xh, xl), (yh, yl) = split_sum("x", "w"), split_sum("y", "w")
    # At most K rows leave the final aggregate: one task reads them all,
    # whatever the number of shuffle partitions (and with or without AQE).
    sums = assigned.groupBy("cluster").agg(xh.alias("xh"), xl.alias("xl"), yh.alias("yh"), yl.alias("yl"), F.sum("w").alias("n")).coalesce(1)
    mean = "(CAST({0}h AS DECIMAL(20,0)) * {1}BD + CAST({0}l AS DECIMAL(20,0))) DIV CAST(n AS DECIMAL(20,0))"
    return sums.select("cluster", *(F.expr(mean.format(c, 1 << LOW_BITS)).alias(c) for c in ("x", "y")), "n")


def centres_frame(spark: SparkSession, centres: Sequence[tuple[int, int]]) -> DataFrame:
    """The (at most K) centres as ``(cluster int, x bigint, y bigint)``."""
    return literal_frame(spark, [(i, int(x), int(y)) for i, (x, y) in enumerate(centres)],
                         ["cluster", "x", "y"], ["int", "bigint", "bigint"])


def cluster_means(points: DataFrame, centres: Sequence[tuple[int, int]], lines: Lines | None = None) -> DataFrame:
    """The centres after one step, ``(cluster, x, y)``; a centre without
    points keeps its position. Both joined sides have at most K rows."""
    old = centres_frame(points.sparkSession, centres)
    new = step_means(points, centres, lines).select("cluster", F.col("x").alias("nx"), F.col("y").alias("ny"))
    return old.join(F.broadcast(new), "cluster", "left").select(
        "cluster", F.coalesce("nx", "x").alias("x"), F.coalesce("ny", "y").alias("y"))


def centre_movement(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row ``movement``: the sum over centres of the squared distance
    between their old and new positions (K rows each side)."""
    o = old.select("cluster", F.col("x").alias("ox"), F.col("y").alias("oy"))
    d = o.join(F.broadcast(new), "cluster", "inner").select(
        squared_distance(F.col("x"), F.col("y"), F.col("ox"), F.col("oy")).alias("d"))
    return d.agg(F.coalesce(F.sum("d"), F.lit(0.0)).alias("movement"))


def movement(old: Sequence[tuple[int, int]], new: Sequence[tuple[int, int]]) -> float:
    """Summed squared movement of K driver-side centres (exact integers)."""
    if len(old) != len(new):
        raise ValueError("centre lists differ in length")
    return float(sum((a - c) ** 2 + (b - d) ** 2 for (a, b), (c, d) in zip(old, new)))


@dataclass(frozen=True)
class KMeansResult:
    centres: Centres
    iterations: int
    movement: float
    converged: bool
    # For each step, the weight of the points that took part in it and the bands read.
    moved: list[int] = field(default_factory=list)
    bands: list[int] = field(default_factory=list)

    def frame(self, spark: SparkSession) -> DataFrame:
        """``(cluster int, x bigint, y bigint, iterations int, movement
        double, converged boolean)``; a run that hit the iteration cap has
        ``converged`` false."""
        return centres_frame(spark, self.centres).select(
            "*", F.lit(self.iterations).cast("int").alias("iterations"),
            F.lit(self.movement).cast("double").alias("movement"),
            F.lit(self.converged).alias("converged"))


def truncated(total: int, n: int) -> int:
    """The quotient of integers, truncated toward zero."""
    return total // n if total >= 0 else -(-total // n)


def moved_sums() -> list:
    """Weight and the two halves of the weighted sum of y."""
    yh, yl = split_sum("y", "w")
    return [F.expr("sum(w)").alias("n"), yh.alias("yh"), yl.alias("yl")]


class ClusterSums:
    """Weight and coordinate sums of K clusters, kept up to date by the points that
    change their cluster."""

    def __init__(self, points: DataFrame, lines: Lines, k: int):
        w = point_weight(points).cast("bigint")
        columns = [F.col("x").cast("bigint").alias("x"), F.col("y").cast("bigint").alias("y"), w.alias("w")]
        self.points, self.lines, self.bits = points.select(*columns, *(["band"] if "band" in points.columns else [])), lines, cell_bits(lines)
        self.before: Voronoi | None = None
        self.window: Window | None = None
        self.n, self.x, self.y = [0] * k, [0] * k, [0] * k
        self.moved: list[int] = []
        self.bands: list[int] = []

    def step(self, centres: Centres) -> None:
        """Bring the sums to these centres."""
        now = Voronoi(centres, self.lines)
        rows = now.moved(self.before) if self.before else [(x, a, b, -1, i) for x, a, b, i in now.all()]
        self.moved.append(0)
        self.bands.append(0)
        far = []
        for x, a, b, old, new in rows:
            if self.window and self.window.covers(x, a, b):
                self.move(old, new, x, *self.window.sums(x, a, b))
            else:
                far.append((x, a, b, old, new))
        if far:
            for r in self.read(far, ["old", "new"]).groupBy("x", "old", "new").agg(*moved_sums()).coalesce(1).collect():
                # at most one row per interval that moved
                self.move(r["old"], r["new"], r["x"], r["n"], (r["yh"] << LOW_BITS) + r["yl"])
            self.hold(now, rows)
        self.before = now

    def move(self, old: int, new: int, x: int, n: int, y: int) -> None:
        self.moved[-1] += n
        for c, sign in ((new, 1), (old, -1)):
            if c >= 0:
                self.n[c] += sign * n
                self.x[c] += sign * n * x
                self.y[c] += sign * y

    def read(self, rows: list[tuple[int, ...]], names: list[str]) -> DataFrame:
        """The points of these intervals; only the bands that they touch are read."""
        points = self.points
        if "band" in points.columns:
            bands = {k for x, a, b, *_ in rows for k in range(self.lines[x].band_of(a), self.lines[x].band_of(b) + 1)}
            self.bands[-1] += len(bands)
            points = points.filter(F.col("band").isin(sorted(bands)))
        return join_intervals(points, interval_table(points.sparkSession, rows, self.bits, names), self.bits)

    def hold(self, now: Voronoi, rows: list[tuple[int, ...]]) -> None:
        """Fetch the points on both sides of the borders, if the next steps are likely to
        move the borders among so few: borders move less from step to step."""
        self.window = None
        if not self.before or 2 * AHEAD * self.moved[-1] > WINDOW_POINTS:
            return
        margin = {x: AHEAD for x in self.lines}
        for x, a, b, *_ in rows:
            margin[x] = max(margin[x], AHEAD * (b - a + 1))
        ranges = around_borders(now, self.lines, margin)
        if not ranges:
            return
        found = self.read(ranges, []).select("x", "y", "w").limit(WINDOW_POINTS + 1).toArrow()
        if found.num_rows <= WINDOW_POINTS:  # else the steps go on reading
            self.window = Window(ranges, *(found.column(c).to_numpy() for c in ("x", "y", "w")), LOW_BITS)

    def means(self, centres: Centres) -> Centres:
        """Truncated means; an empty cluster keeps its centre."""
        return [(truncated(self.x[i], n), truncated(self.y[i], n)) if (n := self.n[i]) else c for i, c in enumerate(centres)]


def kmeans(points: DataFrame, centres: Sequence[tuple[int, int]], eta: float,
           max_iterations: int, lines: Lines | None = None) -> KMeansResult:
    """Run the steps until the movement is below ``eta`` or the cap is
    reached; return the centres of the last step in both cases.

    Each step is at most one Spark job over ``points`` (best: the banded points with
    their ``lines``) that returns at most one row per moved interval."""
    current: Centres = [(int(x), int(y)) for x, y in centres]
    if not current:
        raise ValueError("no initial centres")
    if max_iterations <= 0:
        raise ValueError("max_iterations must be positive")
    lines = lines or lines_of(points)
    sums = ClusterSums(points, lines, len(current)) if lines else None
    moved = float("inf")
    it = 0
    while it < max_iterations:
        it += 1
        if sums:
            sums.step(current)
            nxt = sums.means(current)
        else:
            means = {r["cluster"]: (int(r["x"]), int(r["y"])) for r in step_means(points, current).collect()}
            nxt = [means.get(i, c) for i, c in enumerate(current)]
        moved = movement(current, nxt)
        current = nxt
        if moved < eta:
            break
    return KMeansResult(current, it, moved, moved < eta, *((sums.moved, sums.bands) if sums else ()))
