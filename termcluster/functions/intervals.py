"""Nearest centres as intervals of y.

On one vertical line x the squared distance to a centre is y**2 plus a linear function
of y. So the nearest centre, ties to the lower index, changes at most K - 1 times along
the line, and each centre is nearest on one interval at most. Between two centres the
one with the larger y wins from some integer y on; a stack of centres ordered by y then
gives the intervals of a line in K log K steps, in exact integers of any size.

The points of the clustering lie on few lines (one for each term), and the intervals
don't depend on how many points there are. A point finds its centre by a join on its
line and a cell of y (2**bits values wide), with y between the ends of the interval: it
meets the intervals that overlap its cell, one or two as a rule, instead of K centres.

All of this is plain arithmetic over K centres and the lines, on the driver, where the
centres are held anyway."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Centres = Sequence[tuple[int, int]]
# (from y, to y, index of the centre)
Interval = tuple[int, int, int]
# Intervals are cut at cells so that no line has more than so many of them.
CELLS = 1 << 12


def wins_from(x: int, low: tuple[int, int, int], high: tuple[int, int, int]) -> int:
    """The smallest y at which ``high`` is nearer than ``low``, or as near with the
    lower index; both are (y, x, index) with low's y below high's."""
    (ya, xa, a), (yb, xb, b) = low, high
    n = (x - xb) ** 2 + yb * yb - (x - xa) ** 2 - ya * ya
    d = 2 * (yb - ya)
    return n // d + 1 if b > a else -(-n // d)


def line_intervals(x: int, centres: Centres, least: int, most: int) -> list[Interval]:
    """The intervals of the line x between ``least`` and ``most``, ascending; together
    they cover every y there once."""
    stack: list[tuple[tuple[int, int, int], int]] = []  # a centre and where it begins
    ordered = sorted((cy, (x - cx) ** 2, i, cx) for i, (cx, cy) in enumerate(centres))
    held = None
    for cy, _, i, cx in ordered:
        if cy == held:
            continue  # as high as the one before, and no nearer
        held, c, begin = cy, (cy, cx, i), least
        while stack:
            begin = max(least, wins_from(x, stack[-1][0], c))
            if begin > stack[-1][1]:
                break
            stack.pop()
        else:
            begin = least
        if begin <= most:
            stack.append((c, begin))
    ends = [begin - 1 for _, begin in stack[1:]] + [most]
    return [(begin, end, c[2]) for (c, begin), end in zip(stack, ends)]


def reachable(x: int, xs: np.ndarray, ys: np.ndarray, least: int, most: int) -> np.ndarray:
    """Indexes of the centres that can be nearest somewhere on this part of the line: a
    centre farther away in x alone than some centre ever gets can't."""
    dx = (xs - x) ** 2
    far = dx + np.maximum((ys - least) ** 2, (ys - most) ** 2)
    return np.flatnonzero(dx <= far.min() * (1 + 1e-9) + 1)


@dataclass(frozen=True)
class Line:
    """The points of one x: their least and largest y, how many there are, and the
    bands that hold them, each ``1 << width`` values of y wide."""

    least: int
    most: int
    count: int
    band: int = 0
    width: int = 62

    def band_of(self, y: int) -> int:
        return self.band + ((y - self.least) >> self.width)


Lines = dict[int, Line]


def with_bands(lines: Lines, points: int) -> Lines:
    """Lines dealt over bands of about ``points`` points: lines with more have several
    bands (fewer than twice the least number), short lines share one with their
    neighbours."""
    out, band, held = {}, 0, 0
    for x, line in sorted(lines.items()):
        if held and held + line.count > points:
            band, held = band + 1, 0
        width, needed = 0, -(-line.count // points)
        while width < 62 and ((line.most - line.least) >> (width + 1)) + 1 >= needed:
            width += 1
        out[x] = replace(line, band=band, width=width)
        held += line.count
        band = out[x].band_of(line.most)
    return out


def band_intervals(lines: Lines) -> list[tuple[int, int, int, int]]:
    """(x, from y, to y, band), covering every line."""
    return [(x, line.least + (k << line.width), min(line.most, line.least + ((k + 1) << line.width) - 1), line.band + k)
            for x, line in lines.items() for k in range(line.band_of(line.most) - line.band + 1)]


class Voronoi:
    """The intervals of some lines for some centres."""

    def __init__(self, centres: Centres, lines: Lines):
        if not centres:
            raise ValueError("no centres")
        xs, ys = (np.array([float(c[k]) for c in centres]) for k in (0, 1))
        self.lines: dict[int, list[Interval]] = {}
        for x, line in lines.items():
            near = reachable(x, xs, ys, line.least, line.most).tolist()
            found = line_intervals(x, [centres[i] for i in near], line.least, line.most)
            self.lines[x] = [(a, b, near[i]) for a, b, i in found]

    def moved(self, before: Voronoi) -> list[tuple[int, int, int, int, int]]:
        """(x, from y, to y, centre before, centre now) where the nearest centre isn't
        the same; each line is walked once."""
        out = []
        for x, now in self.lines.items():
            old, k = before.lines[x], 0
            for a, b, i in now:
                while old[k][1] < a:
                    k += 1
                j = k
                while j < len(old) and old[j][0] <= b:
                    if old[j][2] != i:
                        out.append((x, max(a, old[j][0]), min(b, old[j][1]), old[j][2], i))
                    j += 1
        return out

    def all(self) -> list[tuple[int, int, int, int]]:
        return [(x, a, b, i) for x, found in self.lines.items() for a, b, i in found]


def cell_bits(lines: Lines, cells: int = CELLS) -> int:
    """The width of a cell, so that all lines together have at most ``cells`` (and one
    more each)."""
    bits = 0
    while sum((line.most - line.least) >> bits for line in lines.values()) > cells:
        bits += 1
    return bits


def interval_table(spark: SparkSession, rows: Iterable[tuple[int, ...]], bits: int, names: Sequence[str]) -> DataFrame:
    """Intervals (x, from y, to y, ...) cut at cells: ``_x, _cell, _from, _to`` and
    ``names``. At most one row for each interval and cell, so its size is bounded by
    the lines, the cells and the centres."""
    rows = list(rows)
    x, a, b, *rest = (np.array(c, np.int64) for c in zip(*rows)) if rows else [np.zeros(0, np.int64)] * (3 + len(names))
    n = (b >> bits) - (a >> bits) + 1
    at = np.repeat(np.arange(len(rows)), n)
    cell = (a >> bits)[at] + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
    columns = {"_x": x[at], "_cell": cell, "_from": a[at], "_to": b[at], **{k: v[at] for k, v in zip(names, rest, strict=True)}}
    return spark.createDataFrame(pa.table(columns))


def join_intervals(points: DataFrame, table: DataFrame, bits: int, x: str = "x", y: str = "y") -> DataFrame:
    """The points that lie in an interval, with its columns. The table holds at most
    ``CELLS`` rows besides two per interval, so it is broadcast."""
    keyed = points.selectExpr("*", f"CAST(`{x}` AS BIGINT) AS _px", f"CAST(`{y}` AS BIGINT) AS _py", f"shiftright(CAST(`{y}` AS BIGINT), {bits}) AS _pc")
    inside = F.expr("_px = _x AND _pc = _cell AND _py BETWEEN _from AND _to")
    return keyed.join(F.broadcast(table), inside).drop("_px", "_py", "_pc", "_x", "_cell", "_from", "_to")


class Window:
    """All points in some ranges of some lines, held by the driver: sorted, with
    running sums, so that the sums of any interval inside are two look-ups."""

    def __init__(self, ranges: list[tuple[int, int, int]], x: np.ndarray, y: np.ndarray, w: np.ndarray, low_bits: int):
        self.low_bits = low_bits
        self.ranges: dict[int, list[tuple[int, int]]] = {}
        self.held: dict[int, tuple[np.ndarray, ...]] = {}
        for line, a, b in ranges:
            self.ranges.setdefault(line, []).append((a, b))
        for line in self.ranges:
            mine = np.flatnonzero(x == line)
            mine = mine[np.argsort(y[mine], kind="stable")]
            ys, ws = y[mine], w[mine]
            self.held[line] = (ys, *(np.append(0, np.cumsum(v)) for v in (ws, ws * (ys >> low_bits), ws * (ys & (1 << low_bits) - 1))))

    def covers(self, x: int, a: int, b: int) -> bool:
        return any(lo <= a and b <= hi for lo, hi in self.ranges.get(x, ()))

    def sums(self, x: int, a: int, b: int) -> tuple[int, int]:
        """Weight, and weighted sum of y, of the points from y = a to y = b."""
        ys, n, high, low = self.held[x]
        i, j = np.searchsorted(ys, (a, b + 1))
        return int(n[j] - n[i]), (int(high[j] - high[i]) << self.low_bits) + int(low[j] - low[i])


def around_borders(voronoi: Voronoi, lines: Lines, margin: dict[int, int]) -> list[tuple[int, int, int]]:
    """Ranges of ``margin[x]`` values on either side of every border between two
    intervals, joined where they overlap."""
    out: list[tuple[int, int, int]] = []
    for x, found in voronoi.lines.items():
        last = None
        for begin, _, _ in found[1:]:
            a, b = max(lines[x].least, begin - margin[x]), min(lines[x].most, begin + margin[x])
            if last and a <= last[2] + 1:
                last = out[-1] = (x, last[1], b)
            else:
                last = (x, a, b)
                out.append(last)
    return out
