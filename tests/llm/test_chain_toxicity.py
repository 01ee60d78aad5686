import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm.brute import frame
from termcluster.llm import chain_toxicity
from termcluster.llm.chain_toxicity import CATEGORIES, derived, fit, fit_chain, hashed, logit, score
from termcluster.llm.training_sample import held_out, labelled_sample

LABELS = "doc_id long, quality int, toxic int"
DATA = "/root/testdata/sf0.01"


def labelled(seed=1, n=1200):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(300)]
    bad_words = [f"grr{k}" for k in range(6)]
    rows, labels = [], []
    for i in range(n):
        ws = [r.choice(vocab) for _ in range(r.randint(20, 60))]
        toxic = i % 5 == 0
        for _ in range(r.randint(1, 4) if toxic else 0):
            ws[r.randrange(len(ws))] = r.choice(bad_words)
        rows.append((i, " ".join(ws)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_finds_held_out_toxic_texts(spark):
    rows, labels = labelled()
    docs, table = frame(spark, rows), spark.createDataFrame(labels, LABELS)
    got = {r.id: r for r in score(docs, fit(docs, table)).withColumn("ho", held_out("id")).collect()}
    truth = {i: y for i, _, y in labels}
    out = [i for i in got if got[i].ho]
    assert np.mean([(got[i].toxic >= 0.5) == bool(truth[i]) for i in out]) > 0.95
    assert np.mean([got[i].marked > 0.5 for i in out if truth[i]]) > 0.9


def test_accuracy_on_the_given_labels(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    scored = score(docs, fit(docs, labels)).withColumnRenamed("toxic", "p").join(labels, F.col("id") == F.col("doc_id")).filter(held_out("id")).collect()
    y, p = np.array([r.toxic for r in scored]), np.array([r.p >= 0.5 for r in scored])
    assert (y == p).mean() > 0.95


def test_derived_categories_are_nested():
    rows, labels = labelled(2)
    y = derived([w for _, w in hashed(pa.array([t for _, t in rows]))], np.array([x for _, _, x in labels]))
    assert y.shape[1] == len(CATEGORIES) and (y[:, 1] <= y[:, 0]).all() and y[y[:, 2] == 1, 0].mean() > 0.9


def test_later_links_use_earlier_probabilities():
    rows, labels = labelled(3)
    links = fit_chain([t for _, t in rows], [y for _, _, y in labels], 0.2).links
    assert [len(x.earlier) for x in links] == [0, 1, 2] and links[2].earlier.any()


def test_nulls_empty_tables_and_missing_classes(spark):
    rows, labels = labelled(4, 60)
    docs = frame(spark, rows + [(900, None), (901, ""), (None, "no id")])
    table = spark.createDataFrame(labels + [(None, 1, 1), (2, 1, None)], LABELS)
    got = {r.id: r for r in score(docs, fit(docs, table)).collect()}
    assert got[900].toxic == got[901].toxic and 0 <= got[None].toxic <= 1
    clean = fit(docs, table.filter("toxic = 0"))
    assert max(r.toxic for r in score(docs, clean).collect()) < 0.01
    assert score(frame(spark, []), clean).collect() == []
    assert abs(float(logit(np.array(0.5)))) < 1e-9


def test_sample_is_bounded(spark):
    rows, labels = labelled(5, 90)
    docs, table = frame(spark, rows), spark.createDataFrame(labels, LABELS)
    texts, share = labelled_sample(docs, table, "doc_id", "text", "toxic", 7, 2000)
    assert len(texts[0]) <= 7 and all(sum(len(t) for _, t in x) <= 2000 for x in texts.values()) and 0.1 < share < 0.3


def test_training_takes_three_thousand_texts_a_class(spark):
    rows = [(i, f"text number {i}") for i in range(10000)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i, _ in rows], LABELS)
    texts, _ = labelled_sample(frame(spark, rows), labels, "doc_id", "text", "toxic", chain_toxicity.PER_CLASS, chain_toxicity.SAMPLE_BYTES)
    assert [len(texts[y]) for y in (0, 1)] == [3000, 3000] and chain_toxicity.SAMPLE_BYTES == 24 << 20


def test_telling_features_equal_plain_counts():
    rows, labels = labelled(6, 200)
    hashes, toxic = [h for h, _ in hashed(pa.array([t for _, t in rows]))], np.array([x for _, _, x in labels])
    n, n_1 = len(toxic), toxic.sum()
    gain = {}
    for v in set(np.concatenate(hashes).tolist()):
        has = np.array([v in h for h in hashes])
        cells = [((has & (toxic == y)).sum(), has.sum() * k / n, ((~has) & (toxic == y)).sum(), (~has).sum() * k / n) for y, k in ((1, n_1), (0, n - n_1))]
        g = sum(a * np.log(a / b) for c in cells for a, b in (c[:2], c[2:]) if a)
        if has.sum() >= chain_toxicity.MARKER_TEXTS and g >= chain_toxicity.LEAST_GAIN:
            gain[v] = g
    assert 0 < len(gain) <= chain_toxicity.FEATURES
    assert chain_toxicity.telling(hashes, toxic).tolist() == sorted(gain)
