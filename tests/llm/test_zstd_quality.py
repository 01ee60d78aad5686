import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import frame
from termcluster.llm.training_sample import held_out
from termcluster.llm.zstd_quality import PENALTY, Compressors, fit, logistic, score, train

LABELS = "doc_id long, quality int, toxic int"
DATA = "/root/testdata/sf0.01"


def labelled(seed=1, n=240):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        rows.append((i, " ".join(r.choice(vocab) + ("$$$" if bad else "") for _ in range(r.randint(30, 90)))))
        labels.append((i, int(not bad), 0))
    return rows, labels


def test_separates_held_out_documents(spark):
    rows, labels = labelled()
    docs, table = frame(spark, rows), spark.createDataFrame(labels, LABELS)
    got = {r.id: r for r in score(docs, fit(docs, table)).withColumn("ho", held_out("id")).collect()}
    out = [i for i in got if got[i].ho]
    assert len(out) > 50 and all(got[i].predicted == dict((a, b) for a, b, _ in labels)[i] for i in out)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())


def test_accuracy_on_the_given_labels(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    scored = score(docs, fit(docs, labels)).join(labels, F.col("id") == F.col("doc_id")).filter(held_out("id")).collect()
    y, p = np.array([r.quality for r in scored]), np.array([r.predicted for r in scored])
    assert (y == p).mean() > 0.9


def test_held_out_labels_do_not_matter(spark):
    rows, labels = labelled(2)
    docs, table = frame(spark, rows), spark.createDataFrame(labels, LABELS)
    turned = table.withColumn("quality", F.when(held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = fit(docs, table), fit(docs, turned)
    assert one.good == two.good and (one.weights == two.weights).all()


def test_nulls_empty_tables_and_missing_classes(spark):
    rows, labels = labelled(3, 60)
    rows += [(900, None), (901, ""), (None, "text without id"), (1, "a second text with the id one")]
    docs = frame(spark, rows)
    table = spark.createDataFrame(labels + [(None, 1, 0), (2, None, 0), (3, 1, 0), (901, 0, 0)], LABELS)
    got = {r.id: r for r in score(docs, fit(docs, table)).collect()}
    assert got[900].score == got[901].score and 0 <= got[None].score <= 1
    none = fit(docs, table.limit(0))
    assert {round(r.score, 6) for r in score(docs, none).collect()} == {0.5}
    assert score(frame(spark, []), none).collect() == []


@pytest.mark.parametrize("seed", range(12))
def test_the_fit_converges_on_any_draw(seed):
    """Separable and skewed inputs on which undamped steps run away."""
    r = np.random.default_rng(seed)
    n = int(r.integers(10, 400))
    z = r.standard_normal((n, 3)) ** 3 * r.choice([1, 3, 10], 3) + r.standard_normal(3)
    y = (z[:, 0] + (0 if seed % 2 else r.standard_normal(n)) > np.quantile(z[:, 0], r.uniform(0.05, 0.95))).astype(float)
    x = np.column_stack([z, z * z, np.ones(n)])
    w = logistic(x, y, PENALTY)
    p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
    slope = x.T @ (y - p) - PENALTY * w
    left = slope @ np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + PENALTY * np.eye(len(w)), slope)
    assert np.isfinite(w).all() and left < 1e-6
    assert seed % 2 == 0 or ((p >= 0.5) == (y == 1)).mean() > 0.9  # odd seeds are separable


def test_the_fit_converges_on_many_draws_of_the_labels(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()}
    labels = sorted((r.doc_id, r.quality) for r in spark.read.parquet(f"{DATA}/labels.parquet").collect() if r.quality is not None)
    for seed in range(6):
        random.Random(seed).shuffle(labels)
        cut = len(labels) * 2 // 3
        good, bad = ([docs[i].encode() for i, q in labels[:cut] if q == k] for k in (1, 0))
        model = train(good, bad, len(good) / cut)
        out = labels[cut:]
        scores = model.score(Compressors(model.good, model.bad).features([docs[i].encode() for i, _ in out]))
        assert np.mean((scores >= 0.5) == np.array([q == 1 for _, q in out])) > 0.85, seed
