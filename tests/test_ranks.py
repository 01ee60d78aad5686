"""Row numbers by many tasks, full blocks, numbered samples, large samples."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import rows
from termcluster.operators import mentions as m
from termcluster.operators import postings as p
from termcluster.operators import sampling
from termcluster.operators.ranks import numbered
from termcluster.sources import postings as src
from termcluster.sources.postings import POSTING_SCHEMA


def test_numbered_equals_a_window(spark):
    r = random.Random(1)
    data = [(r.choice("abcc"), r.randrange(20), i) for i in range(2000)]
    df = spark.createDataFrame(data, "k string, v int, i bigint").repartition(6)
    got = rows(numbered(df, ("v", F.col("i").desc()), ("k",)), "k", "rn", "v", "i")
    want = []
    for k in "abc":
        inside = sorted((v, -i) for x, v, i in data if x == k)
        want += [(k, n, v, -i) for n, (v, i) in enumerate(inside)]
    assert got == want
    whole = rows(numbered(df, (F.col("v").desc(), "i")), "rn", "v", "i")
    assert whole == [(n, -v, i) for n, (v, i) in enumerate(sorted((-v, i) for _, v, i in data))]
    assert numbered(df.limit(0), ("v",)).count() == 0


def test_one_value_is_numbered_by_many_tasks(spark):
    df = spark.range(30_000, numPartitions=6).select(F.lit("hot").alias("k"), F.lit(1).alias("v"))
    got = numbered(df, ("v",), ("k",))
    assert sorted(r["rn"] for r in got.select("rn").collect()) == list(range(30_000))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tie = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange("k", "v", "_tie")
        shares = [r["count"] for r in tie.groupBy(F.spark_partition_id()).count().collect()]
        assert len(shares) == 4 and max(shares) < 15_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def blocks(index):
    out = defaultdict(list)
    for r in index.collect():
        out[r["term"]].append((r["block"], r["n"], r["docs"]))
    return {t: sorted(v) for t, v in out.items()}


def test_blocks_are_full_for_hashed_ids(spark):
    ids = [int.from_bytes(hashlib.md5(str(i).encode()).digest()[:7]) for i in range(500)]
    df = spark.createDataFrame([(i, "hot " + ("cold" if k < 9 else "")) for k, i in enumerate(ids)], "doc_id bigint, text string")
    got = blocks(m.term_index(df, ["hot", "cold"], block=64))
    assert [n for _, n, _ in got["hot"]] == [64] * 7 + [52] and [b for b, _, _ in got["hot"]] == list(range(8))
    assert sum((d for _, _, d in got["hot"]), []) == sorted(ids)
    assert got["cold"] == [(0, 9, sorted(ids[:9]))]


def test_blocks_are_bounded_for_a_repeated_id(spark):
    df = spark.createDataFrame([(7, "hot")] * 300 + [(i, "hot") for i in range(50)], "doc_id bigint, text string")
    got = blocks(m.term_index(df, ["hot"], block=32))["hot"]
    assert [n for _, n, _ in got] == [32] * 10 + [30]
    assert sum((d for _, _, d in got), []) == sorted([7] * 300 + list(range(50)))


def test_groups_are_full_for_sparse_and_repeated_answer_ids(spark):
    data = [(1, 1, None, None, 0, "Java"), (1, 2, None, None, 0, "C"), (1, 3, None, None, 0, "x")]
    data += [(2, 10 ** 15 * (1 + i % 60), None, 1, i, None) for i in range(200)]
    data += [(2, 5, None, 2, i, None) for i in range(70)] + [(2, 6, None, 3, 1, None)]
    df = spark.createDataFrame(data, POSTING_SCHEMA).repartition(5)
    got = sorted(p.question_answer_groups(df, part=32).collect(), key=lambda r: (r["question_id"], r["part"]))
    assert [(r["question_id"], r["part"], r["n"]) for r in got] == [(1, k, 32) for k in range(6)] + [(1, 6, 8), (2, 0, 32), (2, 1, 32), (2, 2, 6), (3, 0, 1)]
    pairs = [x for r in got if r["question_id"] == 1 for x in zip(r["answer_ids"], r["scores"])]
    assert pairs == sorted((a, s) for t, a, _, q, s, _ in data if t == 2 and q == 1)


def test_equal_lines_are_sampled_at_their_rate(spark):
    """A third of all lines are one line: its occurrences have draws of their own."""
    df = spark.range(30_000, numPartitions=6).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("value"))
    got = Counter(r["value"] for r in src.sample_lines(df, 0.1, 5).collect())
    assert abs(got["hot"] - 1000) < 150 and abs(sum(got.values()) - 3000) < 250
    assert got == Counter(r["value"] for r in src.sample_lines(df.repartition(3), 0.1, 5).collect())
    once = Counter(r["value"] for r in src.sample_lines(df, 0.1, 5, with_replacement=False).collect())
    assert abs(once["hot"] - 1000) < 150 and max(n for v, n in once.items() if v != "hot") == 1


def test_hot_lines_are_numbered_in_chunks(spark, monkeypatch):
    df = spark.createDataFrame([("hot",)] * 1000 + [("a",), ("a",), (None,)], "value string")
    want = sorted(r["value"] for r in src.sample_lines(df, 0.5, 1).collect())
    monkeypatch.setattr(src, "NUMBERS", 64)
    assert sorted(r["value"] for r in src.sample_lines(df, 0.5, 1).collect()) == want


@pytest.mark.parametrize("n", [1, 700, 999, 2999, 3000, 5000])
def test_large_samples_equal_the_sorted_one(spark, n):
    v = spark.range(3000).selectExpr("id", "cast(id % 5 as int) as x", "cast(id % 97 as int) as y").repartition(4)
    want = sorted(range(3000), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())[:n]
    assert [i for (i,) in rows(sampling.sample_global(v, n, 42, one_task=3), "id")] == sorted(want)


def test_large_samples_of_repeated_ids(spark):
    v = spark.range(3000).selectExpr("id % 3 as id", "cast(id as int) as x")
    got = Counter(i for (i,) in rows(sampling.sample_global(v, 1500, 42, one_task=10), "id"))
    order = sorted(range(3), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
    assert got == {order[0]: 1000, order[1]: 500}


def test_no_task_holds_a_large_sample(spark):
    """Ten million of twenty million rows: the plan sorts none but the border's."""
    v = spark.range(20_000_000, numPartitions=8).select("id", F.lit(0).alias("x"), F.lit(1).alias("y"))
    got = sampling.sample_global(v, 10_000_000, 42, one_task=1000)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert all(int(x.split("limit=")[1].split(",")[0]) <= 1000 for x in plan.splitlines() if "TakeOrdered" in x)
    assert got.count() == 10_000_000
