"""Sampling, integer k-means and the cluster report."""

import random

import pytest

from conftest import rows
from termcluster.operators import kmeans as km
from termcluster.operators import report as rep
from termcluster.operators import sampling
from termcluster.params import LANGUAGES, ClusterParams

SPREAD = 50000


def points(spark, data, weighted=False):
    if weighted:
        return spark.createDataFrame(data, "x int, y int, w bigint")
    return spark.createDataFrame(data, "x int, y int")


def report(df):
    return [tuple(r) for r in df.collect()]


# --- report fixtures -------------------------------------------------------

def test_report_two_single_point_clusters(spark):
    pts = points(spark, [(0, 33), (500000, 8)])
    got = report(rep.cluster_report(pts, [(10, 30), (490000, 5)], LANGUAGES, SPREAD))
    assert got == [("Scala", 100.0, 1, 8), ("JavaScript", 100.0, 1, 33)]


def test_report_one_tag(spark):
    pts = points(spark, [(500000, 6), (500000, 13)])
    got = report(rep.cluster_report(pts, [(100, 0), (480000, 9)], LANGUAGES, SPREAD))
    assert got == [("Scala", 100.0, 2, 9)]


def test_report_tie_larger_x_wins(spark):
    pts = points(spark, [(0, 5), (50000, 8)])
    got = report(rep.cluster_report(pts, [(25000, 6)], LANGUAGES, SPREAD))
    assert got == [(LANGUAGES[1], 50.0, 2, 6)]


def test_report_lines(spark):
    pts = points(spark, [(500000, 6), (500000, 13)])
    lines = [r["line"] for r in rep.report_lines(
        rep.cluster_report(pts, [(100, 0), (480000, 9)], LANGUAGES, SPREAD)).collect()]
    assert lines == ["      9  Scala             (100.0%)            2"]


# --- single operators ------------------------------------------------------

def test_nearest_tie_goes_to_lower_index(spark):
    pts = points(spark, [(5, 0)])
    assert rows(km.assign_nearest(pts, [(0, 0), (10, 0)]), "cluster") == [(0,)]
    assert rows(km.assign_nearest(pts, [(10, 0), (0, 0)]), "cluster") == [(0,)]


def test_duplicate_centres_later_one_stays_empty(spark):
    pts = points(spark, [(1, 1), (2, 2)])
    got = rows(km.cluster_means(pts, [(0, 0), (0, 0)]))
    assert got == [(0, 1, 1), (1, 0, 0)]


def test_empty_centre_kept_in_means_missing_in_report(spark):
    pts = points(spark, [(0, 10), (0, 20)])
    centres = [(0, 15), (900000, 0)]
    assert rows(km.cluster_means(pts, centres)) == [(0, 0, 15), (1, 900000, 0)]
    assert report(rep.cluster_report(pts, centres, LANGUAGES, SPREAD)) == [("JavaScript", 100.0, 2, 15)]


def test_median_even_negative_truncates_toward_zero(spark):
    pts = points(spark, [(0, -4), (0, -3)])
    assert rows(rep.cluster_median(pts, [(0, 0)])) == [(0, -3)]
    pts = points(spark, [(0, 12), (0, 13), (0, 16), (0, 17)])
    assert rows(rep.cluster_median(pts, [(0, 0)])) == [(0, 14)]


def test_negative_mean_truncates_toward_zero(spark):
    pts = points(spark, [(0, -4), (0, -3)])
    assert rows(km.cluster_means(pts, [(0, 0)])) == [(0, 0, -3)]


def test_movement(spark):
    old = km.centres_frame(spark, [(0, 0), (10, 10)])
    new = km.centres_frame(spark, [(3, 4), (10, 10)])
    assert km.centre_movement(old, new).collect()[0]["movement"] == 25.0
    assert km.movement([(0, 0), (10, 10)], [(3, 4), (10, 10)]) == 25.0


# --- sampling --------------------------------------------------------------

def vectors(spark, n=200, strata=5):
    data = [(i, (i % strata) * SPREAD, (i * 37) % 101) for i in range(n)]
    return spark.createDataFrame(data, "id bigint, x int, y int")


def test_sample_exact_and_layout_independent(spark):
    v = vectors(spark)
    a = rows(sampling.sample_per_stratum(v, 3, 42), "x", "id")
    b = rows(sampling.sample_per_stratum(v.repartition(7), 3, 42), "x", "id")
    assert a == b
    assert len(a) == 15 and all(sum(1 for x, _ in a if x == s * SPREAD) == 3 for s in range(5))
    g1 = rows(sampling.sample_global(v, 15, 42), "id")
    g2 = rows(sampling.sample_global(v.repartition(3), 15, 42), "id")
    assert g1 == g2 and len(g1) == 15


def test_sample_plan_limits_before_shuffle(spark):
    plan = sampling.sample_per_stratum(vectors(spark), 3, 42)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_initial_centres_checks(spark):
    v = vectors(spark, n=12, strata=5)   # strata of 3 or 2 rows
    with pytest.raises(ValueError):
        sampling.initial_centres(v, 15, 3, 42)
    with pytest.raises(ValueError):
        ClusterParams(terms=("a", "b"), kernels=3).per_stratum
    with pytest.raises(ValueError):
        ClusterParams(spread=0)


# --- k-means against a brute-force implementation --------------------------

def brute_kmeans(pts, centres, eta, max_it):
    """Plain-Python integer k-means with the same rules (test oracle)."""
    def d(p, c):
        return float(p[0] - c[0]) ** 2 + float(p[1] - c[1]) ** 2
    it = 0
    while True:
        it += 1
        groups = {}
        for p in pts:
            best = min(range(len(centres)), key=lambda i: (d(p, centres[i]), i))
            groups.setdefault(best, []).append(p)
        new = []
        for i, c in enumerate(centres):
            g = groups.get(i)
            if not g:
                new.append(c)
                continue
            sx, sy, n = sum(p[0] for p in g), sum(p[1] for p in g), len(g)
            new.append((int(sx / n) if sx >= 0 else -int(-sx // n),
                        int(sy / n) if sy >= 0 else -int(-sy // n)))
        moved = sum(d(a, b) for a, b in zip(centres, new))
        centres = new
        if moved < eta or it >= max_it:
            return centres, it


@pytest.mark.parametrize("seed", [1, 2])
def test_kmeans_matches_brute_force_weighted_and_not(spark, seed):
    rnd = random.Random(seed)
    pts = [(rnd.randrange(5) * 1000, rnd.randrange(-50, 400)) for _ in range(300)]
    centres = [(rnd.randrange(5) * 1000, rnd.randrange(0, 300)) for _ in range(6)]
    want, want_it = brute_kmeans(pts, centres, 20.0, 120)
    plain = km.kmeans(points(spark, pts), centres, 20.0, 120)
    weighted = km.kmeans(km.weighted_points(points(spark, pts)), centres, 20.0, 120)
    assert plain.centres == weighted.centres == want
    assert plain.iterations == weighted.iterations == want_it


def test_kmeans_respects_iteration_cap(spark):
    pts = points(spark, [(0, i * 100) for i in range(50)])
    r = km.kmeans(pts, [(0, 0), (0, 1)], eta=-1.0, max_iterations=3)
    assert r.iterations == 3


def test_report_sizes_sum_to_points(spark):
    rnd = random.Random(3)
    data = [(rnd.randrange(5) * SPREAD, rnd.randrange(100)) for _ in range(400)]
    pts = points(spark, data)
    centres = [(s * SPREAD, 50) for s in range(5)]
    sizes = rows(rep.cluster_sizes(km.weighted_points(pts), centres))
    assert sum(s for _, s in sizes) == 400


def test_many_centres_step_matches_brute_force(spark):
    """A large K (above the reference's 45) keeps the exact tie rule."""
    rnd = random.Random(7)
    pts = [(rnd.randrange(15) * 50000, rnd.randrange(0, 2000)) for _ in range(500)]
    centres = [(rnd.randrange(15) * 50000, rnd.randrange(0, 2000)) for _ in range(60)]
    want, _ = brute_kmeans(pts, centres, float("inf"), 1)   # one step
    got = km.kmeans(points(spark, pts), centres, float("inf"), 1)
    assert got.centres == want and got.iterations == 1


@pytest.mark.parametrize("seed", range(3))
def test_median_matches_brute_force(spark, seed):
    """Scores of both signs over many buckets, even sizes, heavy weights."""
    rng = random.Random(seed)
    pts = [(rng.choice([0, 10**6, 2 * 10**6]), rng.choice([rng.randint(-2**31, 2**31 - 1), rng.randint(-3, 3), 65536 * rng.randint(-2, 2)]),
            rng.choice([1, 2, 999])) for _ in range(120)]
    pts = list({(x, y): (x, y, w) for x, y, w in pts}.values())
    df = spark.createDataFrame(pts, "x int, y int, w bigint")
    centres = [(0, 0), (10**6, 0), (2 * 10**6, 0)]
    got = {r["cluster"]: r["median"] for r in rep.cluster_median(df, centres).collect()}
    members = {}
    for x, y, w in pts:
        c = min(range(3), key=lambda i: ((x - centres[i][0]) ** 2 + float(y) ** 2, i))
        members.setdefault(c, []).extend([y] * w)
    want = {}
    for c, ys in members.items():
        ys.sort()
        want[c] = int((ys[(len(ys) - 1) // 2] + ys[len(ys) // 2]) / 2)
    assert got == want


def test_iteration_cap_is_reported(spark):
    df = spark.createDataFrame([(0, 0), (0, 10), (0, 100)], "x int, y int")
    capped = km.kmeans(df, [(0, 0), (0, 1)], 1.0, 1)
    assert not capped.converged and not capped.frame(spark).first()["converged"]
    assert km.kmeans(df, [(0, 0), (0, 1)], 1.0, 50).converged


def test_label_outside_the_terms_fails_with_ansi_off(spark):
    from termcluster.functions.geometry import term_label
    ansi = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = spark.createDataFrame([(30,)], "x int")
        with pytest.raises(Exception, match="no term for x"):
            df.select(term_label("x", 10, ("a", "b", "c"))).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", ansi)


def test_report_can_be_read_again(spark):
    from termcluster.operators.clustering import cluster_questions
    from termcluster.sources.postings import POSTING_SCHEMA
    data = [(1, q, None, None, 0, ("Java", "Scala")[q % 2]) for q in range(1, 31)]
    data += [(2, 100 + q, None, q, (q * 13) % 40, None) for q in range(1, 31)]
    run = cluster_questions(spark.createDataFrame(data, POSTING_SCHEMA),
                            ClusterParams(terms=("Java", "Scala"), kernels=4))
    before = report(run.report())
    assert report(run.report()) == before and sum(r[2] for r in before) == 30


def test_print_report(spark):
    pts = points(spark, [(500000, 20), (500000, 40), (0, 7)])
    lines = []
    rep.print_report(rep.cluster_report(pts, [(0, 0), (500000, 30)], LANGUAGES, SPREAD), lines.append)
    assert lines[:3] == list(rep.REPORT_HEADER)
    assert lines[3:] == ["      7  JavaScript        (100.0%)            1",
                         "     30  Scala             (100.0%)            2"]
