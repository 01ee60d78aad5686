import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from termcluster.llm.rns_negatives import hard_negatives, moduli, scaled_bounds, scores

SCHEMA = "vec_id long, embedding array<float>, label int"
ANCHOR = "id % 10 = 0"
COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def plain(rows, anchor=lambda i: i % 10 == 0, positives=5, negatives=5, low=80, high=100, den=100):
    live = []
    for at, (i, v, label) in enumerate(rows):
        if None in (i, v, label) or any(x is None or not math.isfinite(x) for x in v):
            continue
        live.append((at, i, label, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for at, i, label, v in live:
        if not anchor(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, k, other) for k, j, other, w in live if k != at)
        for ps, pid, _, _ in [x for x in scored if x[3] == label][:positives]:
            hits = [x for x in scored if x[3] != label and low * -ps <= den * -x[0] <= high * -ps][:negatives]
            out += [(i, pid, r, x[1], -ps, -x[0]) for r, x in enumerate(hits, 1)]
    return sorted(out)


def result(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def table(seed=1, n=300, d=16, labels=4):
    r = random.Random(seed)
    centres = [[r.gauss(0, 0.2) for _ in range(d)] for _ in range(labels)]
    rows = []
    for i in range(n):
        label = r.randrange(labels)
        mix = r.randrange(labels) if i % 3 else label
        rows.append((i, [c + r.gauss(0, 0.1) for c in centres[mix]], label))
    return rows


def frame(spark, rows, parts=5):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def test_equals_brute_force(spark):
    rows = table()
    want = plain(rows)
    assert len(want) > 100
    assert result(hard_negatives(frame(spark, rows), ANCHOR)) == want
    assert result(hard_negatives(frame(spark, rows, 1), ANCHOR, block_bytes=8 * 16 * 12)) == want  # several blocks of anchors


def test_odd_rows(spark):
    rows = table(2, 120)
    same = rows[10][1]
    rows += [(200 + i, same, 1 + i % 2) for i in range(40)]  # equal vectors: ties by id
    rows += [(10, rows[10][1], rows[10][2]), (20, rows[21][1], 0), (20, rows[21][1], 0)]  # shared ids
    rows += [(None, same, 1), (900, None, 1), (910, same, None), (920, [float("nan")] + same[1:], 1), (930, [None] + same[1:], 1), (940, [float("inf")] * 16, 2)]
    rows += [(950, [], 1), (960, same[:7], 2), (970, [0.0] * 16, 3), (980, same + [3.0], 1), (990, [-x for x in same], 9)]
    assert result(hard_negatives(frame(spark, rows), ANCHOR)) == plain(rows)


def test_empty_tables_and_clashing_names(spark):
    rows = frame(spark, table(3, 60)).withColumn("rid", F.lit("x")).withColumn("id", F.lit(1)).withColumn("v", F.lit(2)).withColumn("slot", F.lit(0))
    assert result(hard_negatives(rows, ANCHOR)) == plain(table(3, 60))
    for none in (frame(spark, []), frame(spark, [(1, [0.5], 1), (2, [0.5], 1)])):
        got = hard_negatives(none, ANCHOR)
        assert got.collect() == [] and got.columns == list(COLUMNS)


@pytest.mark.parametrize("d", [1, 3, 64, 1000, 2500])
@pytest.mark.parametrize("size", [1, 200, 10 ** 6])
def test_scores_are_exact(d, size):
    r = np.random.default_rng(d * 7 + size)
    a, b = (r.integers(-size, size + 1, (n, d)) for n in (7, 9))
    a[0], b[0], b[1] = size, size, -size  # the largest sums of either sign
    want = a.astype(object) @ b.T.astype(object)
    assert (scores(a.astype(float), b.astype(float)) == want.astype(np.int64)).all()


def test_primes_keep_float32_exact():
    for d in (1, 64, 1024, 5000):
        primes = moduli(d, 10 ** 12)
        assert len(set(primes)) == len(primes) and math.prod(primes) > 2 * 10 ** 12
        assert all(min(d, 1024) * (p // 2) ** 2 <= 1 << 24 for p in primes)


def test_overflow_is_an_error(spark):
    with pytest.raises(OverflowError):
        scores(np.full((1, 4), 2.0 ** 33), np.full((1, 4), 2.0 ** 33))
    assert scores(np.full((1, 2), 2.0 ** 30), np.array([[2.0 ** 30, -1.0]])).item() == 2 ** 60 - 2 ** 30


def test_bounds():
    values = np.array([0, 1, 7, 99, 100, -1, -7, -101, 2 ** 61, -2 ** 61 + 3])
    least, most = scaled_bounds(values, 80, 100, 100)
    for v, x, y in zip(values.tolist(), least.tolist(), most.tolist()):
        assert x == -(-80 * v // 100) and y == v
