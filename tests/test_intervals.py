"""Nearest centres as intervals, and k-means by differences."""

import random

import numpy as np
import pytest

from conftest import rows
from test_kmeans import brute_kmeans, points
from termcluster.functions import intervals as iv
from termcluster.functions.intervals import Line, Voronoi
from termcluster.operators import kmeans as km
from termcluster.operators import report as rep


def nearest(centres, x, y):
    return min(range(len(centres)), key=lambda i: ((x - centres[i][0]) ** 2 + (y - centres[i][1]) ** 2, i))


@pytest.mark.parametrize("seed", range(40))
def test_intervals_equal_distances(seed):
    """Ties, equal centres, centres on and off the lines; and what moves between two
    sets of centres."""
    r = random.Random(seed)
    size, k = r.choice([3, 10, 40]), r.randrange(1, 14)
    centres = [(r.randrange(-size, size), r.randrange(-size, size)) for _ in range(k)]
    later = [(a + r.randrange(-2, 3), b + r.randrange(-3, 4)) for a, b in centres]
    lines = {x: Line(-size - 5, size + 9, 1) for x in r.sample(range(-2 * size, 2 * size), 3)}
    before, now = Voronoi(centres, lines), Voronoi(later, lines)
    moved = {(x, y): (a, b) for x, lo, hi, a, b in now.moved(before) for y in range(lo, hi + 1)}
    for x, line in lines.items():
        found = [(y, i) for a, b, i in before.lines[x] for y in range(a, b + 1)]
        assert found == [(y, nearest(centres, x, y)) for y in range(line.least, line.most + 1)]
        for y in range(line.least, line.most + 1):
            a, b = nearest(centres, x, y), nearest(later, x, y)
            assert moved.get((x, y)) == ((a, b) if a != b else None)


def test_large_coordinates_are_exact():
    big = 2 ** 31 - 1
    centres = [(0, -big), (0, big), (5 * 10 ** 9, 0), (5 * 10 ** 9, 1)]
    v = Voronoi(centres, {0: Line(-big - 1, big, 1), 5 * 10 ** 9: Line(-big, big, 1)})
    assert v.lines[0] == [(-big - 1, 0, 0), (1, big, 1)]
    assert v.lines[5 * 10 ** 9] == [(-big, 0, 2), (1, big, 3)]


def test_points_meet_few_intervals(spark):
    """Candidates a point, counted: with 1000 centres hardly more than with 45."""
    r = random.Random(3)
    data = [(50_000 * r.randrange(15), r.randrange(100_000)) for _ in range(3000)]
    df = points(spark, data)
    lines = km.lines_of(df)
    bits = iv.cell_bits(lines)
    for k, limit in ((45, 1.2), (1000, 3.0)):
        centres = [(50_000 * r.randrange(15), r.randrange(100_000)) for _ in range(k)]
        table = iv.interval_table(spark, Voronoi(centres, lines).all(), bits, ["cluster"])
        cells = {}
        for t in table.collect():
            cells[t["_x"], t["_cell"]] = cells.get((t["_x"], t["_cell"]), 0) + 1
        assert sum(cells[x, y >> bits] for x, y in data) <= limit * len(data)
        got = [(x, y, c) for x, y, c in rows(km.assign_nearest(df, centres, lines), "x", "y", "cluster")]
        assert got == sorted((x, y, nearest(centres, x, y)) for x, y in data)
        assert sum(len(v) for v in Voronoi(centres, lines).lines.values()) <= k + 15 * 15


def test_bands_cover_the_lines():
    lines = iv.with_bands({0: Line(0, 99, 50), 5: Line(-7, 4000, 1000), 9: Line(3, 3, 1), 11: Line(0, 1, 2), 12: Line(5, 9, 99)}, 100)
    found = sorted(iv.band_intervals(lines))
    for x, line in lines.items():
        mine = [(a, b, k) for i, a, b, k in found if i == x]
        assert mine[0][0] == line.least and mine[-1][1] == line.most
        assert all(p[1] + 1 == q[0] and p[2] + 1 == q[2] for p, q in zip(mine, mine[1:]))
        assert all(line.band_of(y) == k for a, b, k in mine for y in (a, b))
    assert len([1 for x, *_ in found if x == 5]) >= 10 and lines[9].band == lines[11].band


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_kmeans_by_differences(spark, seed, monkeypatch):
    """The same centres as brute force, from bands, with and without points held near
    the borders; fewer and fewer points take part."""
    r = random.Random(seed)
    pts = list({(r.randrange(4) * 500, int(r.gauss(0, 300))) for _ in range(1500)})
    centres = r.sample(pts, 12)
    want = brute_kmeans(pts, centres, 5.0, 60)
    banded, lines = km.banded_points(points(spark, pts), points_per_task=100)
    got = km.kmeans(banded, centres, 5.0, 60, lines)
    assert (got.centres, got.iterations) == want
    assert got.moved[0] == len(pts) and sum(got.moved[1:]) < 3 * len(pts) and max(got.moved[-2:]) < len(pts) / 10
    assert sum(1 for b in got.bands if b) < got.iterations  # some steps read nothing
    monkeypatch.setattr(km, "WINDOW_POINTS", 0)
    again = km.kmeans(banded, centres, 5.0, 60, lines)
    assert (again.centres, again.moved) == (got.centres, got.moved)
    assert again.bands[0] == max(again.bands) > min(again.bands)


def test_too_many_lines_take_the_other_way(spark, monkeypatch):
    r = random.Random(4)
    pts = [(r.randrange(1000), r.randrange(1000)) for _ in range(300)]
    centres = r.sample(pts, 5)
    want = brute_kmeans(pts, centres, 20.0, 50)
    assert (lambda k: (k.centres, k.iterations))(km.kmeans(points(spark, pts), centres, 20.0, 50)) == want
    monkeypatch.setattr(km, "MAX_LINES", 100)
    banded, lines = km.banded_points(points(spark, pts))
    assert lines is None
    assert (lambda k: (k.centres, k.iterations))(km.kmeans(banded, centres, 20.0, 50, lines)) == want
    assert rows(rep.cluster_sizes(banded, centres)) == rows(rep.cluster_sizes(banded, centres, None))


def test_sums_past_64_bits(spark):
    """Means of clusters whose weighted sums pass 2**63, with ANSI on and off."""
    w, big = 1 << 41, 2 ** 31 - 1
    data = [(0, big, w), (0, big - 7, w), (0, -big, w), (5 * 10 ** 9, big, 3 * w), (5 * 10 ** 9, big - 3, w)]
    df = spark.createDataFrame(data, "x bigint, y int, w bigint")
    centres = [(0, big), (0, -big), (5 * 10 ** 9, 0)]
    want = [(0, 0, big - 4), (1, 0, -big), (2, 5 * 10 ** 9, big - 1)]
    assert rows(km.cluster_means(df, centres)) == want
    assert km.kmeans(df, centres, 1e30, 1).centres == [(x, y) for _, x, y in want]
    ansi = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert rows(km.cluster_means(df, centres)) == want
    finally:
        spark.conf.set("spark.sql.ansi.enabled", ansi)


def test_window_sums():
    r = np.random.default_rng(1)
    x, y, w = r.integers(0, 2, 200) * 7, r.integers(-1000, 1000, 200), r.integers(1, 2 ** 40, 200)
    held = iv.Window([(0, -500, 100), (7, -1000, 999), (0, 200, 300)], x, y, w, 16)
    assert held.covers(0, -500, 100) and held.covers(0, 200, 250) and not held.covers(0, 50, 250) and not held.covers(3, 0, 0)
    inside = (x == 7) & (y >= -300) & (y <= 44)
    assert held.sums(7, -300, 44) == (int(w[inside].sum()), sum(int(a) * int(b) for a, b in zip(w[inside], y[inside])))


def test_no_points(spark):
    empty = spark.createDataFrame([], "x int, y int")
    banded, lines = km.banded_points(empty)
    assert not lines and km.kmeans(banded, [(1, 2)], 1.0, 3, lines).centres == [(1, 2)]
    assert km.assign_nearest(empty, [(0, 0)]).collect() == []
