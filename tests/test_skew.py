"""Hot keys: one question holds a third of all answers, one term is in
every document. Results must stay whole and exact (nothing dropped or
capped), and the hot groups must come out in bounded pieces."""

from collections import defaultdict

from conftest import rows
from pyspark.sql import functions as F
from termcluster.operators import mentions as m
from termcluster.operators import postings as p
from termcluster.params import LANGUAGES
from termcluster.sources.postings import POSTING_SCHEMA


def skewed_postings(spark, n_questions=60, hot_answers=300):
    data = [(1, q, None, None, 0, LANGUAGES[q % 15]) for q in range(1, n_questions + 1)]
    data += [(2, 10_000 + a, None, 1, a % 97, None) for a in range(hot_answers)]          # hot question 1
    data += [(2, 20_000 + q * 10 + j, None, q, (q * 7 + j) % 50, None)
             for q in range(2, n_questions + 1) for j in range(10)]
    return data, spark.createDataFrame(data, POSTING_SCHEMA).repartition(6)


def test_hot_question_scores_exact(spark):
    data, df = skewed_postings(spark)
    best = defaultdict(lambda: None)
    for t, _, _, parent, score, _ in data:
        if t == 2:
            best[parent] = score if best[parent] is None else max(best[parent], score)
    got = dict(rows(p.question_max_score(df), "question_id", "max_score"))
    assert got == dict(best)
    vec = rows(p.score_vectors(df, LANGUAGES, 50000), "id", "y")
    assert dict(vec) == dict(best)


def test_hot_question_groups_are_bounded_and_whole(spark):
    data, df = skewed_postings(spark)
    g = p.question_answer_groups(df, part=64)
    got = g.collect()
    assert max(r["n"] for r in got) <= 64
    per_q = defaultdict(int)
    for r in got:
        per_q[r["question_id"]] += r["n"]
    assert per_q[1] == 300 and sum(per_q.values()) == 300 + 59 * 10
    assert p.question_answer_pairs(df).count() == 300 + 59 * 10


def test_hot_question_splits_in_groups(spark):
    """A third of the answers on one question, no broadcast: AQE splits the
    join, and the groups are read by tasks with a bounded share."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200000",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100000",
                "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        n = 300_000
        answers = spark.range(n, numPartitions=8).selectExpr(
            "2 AS posting_type", "id", "CAST(NULL AS BIGINT) AS accepted_answer",
            "CASE WHEN id % 3 = 0 THEN 1 ELSE 1 + id % 5000 END AS parent_id",
            "int(id % 100) AS score", "CAST(NULL AS STRING) AS tag")
        questions = spark.range(1, 5001).selectExpr(
            "1 AS posting_type", "id", "CAST(NULL AS BIGINT) AS accepted_answer",
            "CAST(NULL AS BIGINT) AS parent_id", "0 AS score", "'Java' AS tag")
        g = p.question_answer_groups(questions.unionByName(answers), part=1024)
        shares = g.groupBy(F.spark_partition_id().alias("task")).agg(F.sum("n").alias("n")).collect()
        assert sum(r["n"] for r in shares) == n
        assert max(r["n"] for r in shares) < n / 4
        g.collect()
        assert "skew=true" in g._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_term_in_every_document(spark):
    docs = [(i, "the " + ("Java" if i % 3 == 0 else "x")) for i in range(500)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    r = {t: n for t, n, _ in rows(m.rank_terms_all(df, ["the", "Java", "Cobol"]))}
    assert r == {"the": 500, "Java": 167, "Cobol": 0}
    idx = m.term_index(df, ["the"], block=100).collect()
    assert max(x["n"] for x in idx) <= 100 and sum(x["n"] for x in idx) == 500
