import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from termcluster.llm.collocations import Summary, collocations, frequent, merged, phrase_counts
from tests.llm.brute import DOCS, frame

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def plain_counts(rows, max_words=3):
    counts, total = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, max_words + 1):
                counts[lang].update(" ".join(words[i:i + k]) for i in range(len(words) - k + 1))
    return counts, total


def plain(rows, max_words=3, least=10, top=2000):
    """The op12 contract."""
    counts, total = plain_counts(rows, max_words)
    out = []
    for lang, c in counts.items():
        known = {p: f for p, f in c.items() if " " in p and f >= least}
        scored = []
        for p, a in known.items():
            w = p.split(" ")
            if any(f" {p} " in f" {q} " and len(q.split(" ")) > len(w) and 100 * f >= 50 * a for q, f in known.items()):
                continue
            cuts = []
            for k in range(1, len(w)):
                x, y = c[" ".join(w[:k])], c[" ".join(w[k:])]
                cuts.append((10 ** 6 * a * a // (x * y), k, x, y))
            score, _, x, y = min(cuts)
            scored.append((-score, -a, p.encode(), p, x, y))
        for rank, (score, a, _, p, x, y) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p, -a, x, y, total[lang], -score))
    return sorted(out)


def prose(n=300, seed=1):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdé日") for _ in range(r.randint(1, 3))) for _ in range(14)] + ["The", "a b", "X\x00y"]
    fixed = ["new york city", "de la", "New YORK", "in the middle of"]
    rows = []
    for i in range(n):
        words = [r.choice(fixed if r.random() < 0.15 else vocab) + r.choice(["", "", "", ".", ", ", "!?"]) for _ in range(r.randint(0, 120))]
        rows.append((i, "".join(w + r.choice([" ", " ", "\t", "  ", "\n", "\r"]) for w in words), r.choice(["en", "fr", None, ""]), "s", 0))
    return rows


def result(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = prose(seed=seed)
    want = plain(rows)
    assert len(want) > 50 and {x[0] for x in want} == {"en", "fr", "und", ""}
    # many partitions, small blocks and an almost full filter change nothing
    assert result(collocations(frame(spark, rows), partition_bytes=700, entries=500, bits=11)) == want


def test_production_parameters(spark):
    rows = prose(120, 3)
    assert result(collocations(frame(spark, rows))) == plain(rows)


def test_longer_phrases_and_a_short_list(spark):
    rows = prose(60, 4)
    assert result(collocations(frame(spark, rows), max_words=5, least=4, top=7)) == plain(rows, 5, 4, 7)


def test_odd_tables(spark):
    rows = [(1, None, "en", "s", 0), (None, "", "en", "s", 0), (2, " .,\n", None, "s", 0), (2, "a b " * 40, None, "s", 0), (2, "a b " * 40, None, "s", 0),
            (3, "a b a " * 30_000, "en", "s", 0), (4, "x y", "fr", "s", 0), (5, "x y. " * 12, "fr", "s", 0), (6, "x, y " * 12, "de", "s", 0)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("phrase", F.lit("p")).withColumn("n", F.lit(1)).withColumn("txt", F.lit(None))
    assert result(collocations(docs)) == plain(rows)
    assert collocations(frame(spark, [])).collect() == []
    assert collocations(frame(spark, [(1, None)])).collect() == []


def test_counts(spark):
    rows = prose(50, 5)
    counts, total = plain_counts(rows)
    got = {(r.lang, r.phrase): r.n for r in phrase_counts(frame(spark, rows), least=3, bits=11).collect()}
    want = {(x, p): f for x, c in counts.items() for p, f in c.items() if f >= 3} | {(x, ""): f for x, f in total.items()}
    assert got == want


def test_a_third_of_all_words_are_one_phrase(spark):
    rows = [(i, f"hot pair {i % 40}w " * 50, "en", "s", 0) for i in range(60)]
    assert result(collocations(frame(spark, rows, 8), partition_bytes=2000)) == plain(rows)


@pytest.mark.parametrize("seed", range(6))
def test_summaries_keep_every_frequent_key(seed):
    """However the blocks are dealt, less than the threshold is taken from any key."""
    r = np.random.default_rng(seed)
    least = int(r.integers(2, 30))
    keys = (r.zipf(1.3, 20_000) % 5000).astype(np.uint64)
    blocks = [np.unique(x, return_counts=True) for x in np.array_split(keys, 40)]
    whole, count = np.unique(keys, return_counts=True)
    summary = Summary(len(keys) // least + 1)
    for b in blocks:
        summary.merge(*b)
        assert len(summary.keys) <= summary.capacity
    assert summary.taken < least and set(whole[count >= least].tolist()) <= set(summary.keys.tolist())
    got = frequent(blocks, len(keys), least)
    assert dict(zip(*(x.tolist() for x in got))) == dict(zip(whole[count >= least].tolist(), count[count >= least].tolist()))


def test_summaries_take_away():
    s = Summary(2)
    s.merge(np.array([1, 2, 3], np.uint64), np.array([5, 1, 1]))
    assert (s.keys.tolist(), s.counts.tolist(), s.taken) == ([1], [4], 1)
    assert [x.tolist() for x in merged([], [])] == [[], []]
