import math
import random

import numpy as np
from pyspark.sql import functions as F

from termcluster.llm import mcd_quality as m
from tests.llm.brute import base_stats, corpus, frame


def brute_vector(text):
    n, chars, symbols, dup, repeated = base_stats(text)
    lines = sum(bool(x.strip(" \t\n\x0b\x0c\r")) for x in text.split("\n"))
    x = (math.log((chars + 1) / n), math.log1p(10 * symbols / n), dup / max(lines, 1), repeated / n)
    return np.round(np.array(x) * m.GRID / np.array(m.UNITS)) / m.GRID


def brute_verdicts(rows):
    """Concentration steps with numpy, group by group."""
    out, groups = {}, {}
    for i, t, lang, source, _ in rows:
        n, *_, repeated = base_stats(t)
        out[i] = None
        if not (n < 10 or 100 * repeated > 20 * n):
            groups.setdefault((lang, source), []).append((i, brute_vector(t)))
    for members in groups.values():
        x = np.array([v for _, v in members])
        found = []
        for start in (0, 1):
            def fit(y):
                return y.mean(0), m.CONSISTENT * (y.T @ y / len(y) - np.outer(y.mean(0), y.mean(0))) + np.eye(4)
            centre, scatter = fit(x)
            scatter = scatter if start == 0 else np.eye(4)
            chosen = None
            for _ in range(m.STEPS):
                d = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(scatter), x - centre)
                bins = np.minimum(m.BINS - 1, np.floor(m.BINS_PER_DOUBLING * np.log2(1 + d)))
                last = np.sort(bins)[math.ceil(m.CORE * len(x)) - 1]
                if chosen is not None and (chosen == (bins <= last)).all():
                    break
                chosen = bins <= last
                centre, scatter = fit(x[chosen])
            found.append((np.linalg.slogdet(scatter)[1], start, centre, scatter))
        _, _, centre, scatter = min(found, key=lambda f: (round(f[0], 9), f[1]))
        d = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(scatter), x - centre)
        out |= {i: v for (i, _), v in zip(members, d, strict=True)}
    return out


def documents(seed=1):
    r = random.Random(seed)
    rows = [(i, t, r.choice(["en", "de", None]), r.choice(["s0", "s1"]), 0) for i, t in corpus(seed, n=150)]
    for i in range(4):
        words = [f"word{r.randrange(1000)}" for _ in range(60)]
        rows.append((900 + i, " ".join(w + r.choice(["***", "$$$", "|"]) for w in words), "en", "s0", 0))
    rows.append((950, "line one here\nline two here\nline one here\n\n \n\x0b\n" + " ".join(f"u{i}" for i in range(40)), "en", "s0", 0))
    return rows


def test_statistics_equal_brute_force(spark):
    rows = documents() + [(960, "x " * 30 + "a b c d e f g a b c d e", "en", None, 0)]
    got = m.quality_rules(frame(spark, rows)).collect()
    want = {i: base_stats(t) for i, t, *_ in rows}
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want[r.id]
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)


def test_verdicts_equal_brute_force(spark):
    rows = documents(2)
    want = brute_verdicts(rows)
    got = m.quality_rules(frame(spark, rows, 5), keep_row=True).collect()
    for r in got:
        assert (r.distance is None) == (want[r.id] is None)
        if r.distance is not None:
            assert abs(r.distance - want[r.id]) < 1e-6 * (1 + want[r.id]) and r.kept == (want[r.id] <= m.LIMIT)
    assert not any(r.kept for r in got if 900 <= r.id < 904)
    assert sum(r.kept for r in got if r.id < 150 and not r.base_failed) > 100


def test_partitioning_does_not_matter(spark):
    rows = documents(3)
    one, two = ({r.id: r.distance for r in m.quality_rules(frame(spark, rows, p)).collect()} for p in (1, 7))
    assert one == two


def test_empty_table_one_row_repeats_and_clashing_names(spark):
    assert m.quality_rules(frame(spark, [])).collect() == []
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text, None, None, 0), (1, text, None, None, 0), (None, text, "en", "s", 0), (2, None, "en", "s", 0), (3, "", "en", "s", 0)]
    df = frame(spark, rows).withColumn("z1", F.lit("clash")).withColumn("distance", F.lit(1)).withColumn("wins", F.lit(1))
    got = m.quality_rules(df, keep_row=True).collect()
    assert sorted((str(r.id), r.kept, r.base_failed) for r in got) == [("1", True, False), ("1", True, False), ("2", False, True), ("3", False, True), ("None", True, False)]
    assert all(r.row.z1 == "clash" for r in got)


def ridge(n, width, seed):
    """Vectors along a line, with noise: steps move their core slowly, or in a cycle."""
    r = random.Random(seed)
    out = []
    for _ in range(n):
        t = r.random() * width
        out.append([round((t * w + r.gauss(0, 0.3)) * m.GRID) for w in (1, 0.7, 0.2, 0.1)])
    return out


def brute_estimates(vectors, start):
    """The states (determinant, centre) up to the first that occurs again, and where it did."""
    x = np.array(vectors) / m.GRID
    core, states, seen = np.ones(len(x), bool), [], {}
    while True:
        y = x[core]
        centre, scatter = y.mean(0), m.CONSISTENT * (y.T @ y / len(y) - np.outer(y.mean(0), y.mean(0))) + np.eye(4)
        if states == [] and start == 1:
            scatter = np.eye(4)
        elif core.tobytes() in seen:
            return states, seen[core.tobytes()]
        else:
            seen[core.tobytes()] = len(states)
        states.append((np.linalg.slogdet(scatter)[1] / 2, *centre))
        d = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(scatter), x - centre)
        bins = np.minimum(m.BINS - 1, np.floor(m.BINS_PER_DOUBLING * np.log2(1 + d)))
        core = bins <= np.sort(bins)[math.ceil(m.CORE * len(x)) - 1]


def test_steps_go_on_until_estimates_repeat(spark):
    groups = {"slow": ridge(400, 30, 1), "cycle": ridge(400, 12, 2), "fast": ridge(400, 12, 1)}
    rows = [(g, "s", *v) for g, vs in groups.items() for v in vs]
    stats = spark.createDataFrame(rows, "lang string, source string, z1 long, z2 long, z3 long, z4 long")
    got = {(r.glang, r.start): r for r in m.concentrated(stats).collect()}
    late, cycles = set(), set()
    for g, vs in groups.items():
        for start in (0, 1):
            states, first = brute_estimates(vs, start)
            want = min(states[first:])
            e = got[g, start].best
            assert np.allclose((e.det, e.m0, e.m1, e.m2, e.m3), want, rtol=1e-9, atol=1e-9)
            late |= {g} if first > 8 else set()
            cycles |= {g} if len(states) - first > 1 else set()
    assert "slow" in late and cycles == {"cycle"}
