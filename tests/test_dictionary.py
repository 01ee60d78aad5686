"""Long term and tag lists: dictionaries that are joined."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from termcluster.functions.dictionary import dictionary, literal_strings
from termcluster.functions.geometry import term_label
from termcluster.operators import mentions as m
from termcluster.operators import postings as p
from termcluster.sources.postings import POSTING_SCHEMA

LONG = [f"w{i}" for i in range(100_000)]


def corpus(spark, n=200, seed=1):
    r = random.Random(seed)
    data = [(i, " ".join(r.choice(["the", "w5", "x", f"w{r.randrange(300)}", f"w{99_000 + r.randrange(2000)}", ""]) for _ in range(40))) for i in range(n)]
    data += [(n, ""), (n + 1, None), (n + 2, "w5, w5\nw6")]
    return data, spark.createDataFrame(data, "doc_id bigint, text string").repartition(3)


def plain_pairs(data, terms):
    listed = set(terms)
    return sorted((i, t) for i, text in data for t in set((text or "").split(" ")) & listed if text is not None)


def plain_ranks(data, terms, zero):
    counts = {t: 0 for t in terms}
    for _, t in plain_pairs(data, terms):
        counts[t] += 1
    return sorted(((t, n) for t, n in counts.items() if n or zero), key=lambda r: (-r[1], r[0]))


def ranking(df):
    return [(r["term"], r["n"]) for r in df.orderBy("rnk").collect()]


@pytest.fixture(params=["list", "table", "large"])
def terms_as(request, spark, monkeypatch):
    """The same terms as a list, as a DataFrame, and as a list too large to broadcast."""
    if request.param == "large":
        monkeypatch.setattr("termcluster.functions.dictionary.BROADCAST_BYTES", 1)
    if request.param == "table":
        return lambda terms: spark.createDataFrame([(t,) for t in [*terms, terms[0], None]], "term string")
    return lambda terms: terms


def test_mentions_of_a_long_list(spark, terms_as):
    data, df = corpus(spark)
    terms = LONG[:1000] + LONG[99_500:]
    given = terms_as(terms)
    assert rows(m.article_term_pairs(df, given)) == plain_pairs(data, terms)
    assert ranking(m.rank_terms_grouped(df, given)) == plain_ranks(data, terms, False)
    assert ranking(m.rank_terms_all(df, given)) == plain_ranks(data, terms, True)
    index = m.term_index(df, given, block=7)
    assert ranking(m.rank_terms_from_index(index, bounded=False)) == plain_ranks(data, terms, False)


def test_a_hundred_thousand_terms(spark):
    data, df = corpus(spark)
    assert rows(m.article_term_pairs(df, LONG)) == plain_pairs(data, LONG)
    got = ranking(m.rank_terms_all(df, LONG))
    assert got == plain_ranks(data, LONG, True) and len(got) == 100_000


def test_long_lists_join_without_python(spark):
    _, df = corpus(spark, 5)
    plan = m.rank_terms_grouped(df, LONG)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LocalTableScan" in plan and "Python" not in plan


def postings(spark, n=400, tags=300):
    r = random.Random(2)
    data = []
    for q in range(n):
        data.append((1, q, None, None, 0, r.choice([None, "", f"t{r.randrange(tags)}", f"t{r.randrange(tags)}"])))
        if q % 9 == 0:  # repeated question ids
            data.append((1, q, None, None, 0, r.choice([f"t{r.randrange(tags)}", "a", "zz"])))
        data += [(2, 10_000 + 10 * q + k, None, q, r.randrange(-50, 50), None) for k in range(q % 4)]
    return spark.createDataFrame(data, POSTING_SCHEMA)


def test_equal_results_for_a_short_list(spark, monkeypatch):
    """The expression over a short list and the join give the same."""
    df, short = postings(spark, tags=12), tuple(f"t{i}" for i in (3, 1, 11, 7, 0))
    scored = p.question_max_score(df)
    want = rows(p.question_tag_index(scored, short)), rows(p.score_vectors(df, short, 100))
    assert len(want[1]) > 20
    monkeypatch.setattr("termcluster.functions.dictionary.SHORT_LIST", 0)
    assert (rows(p.question_tag_index(scored, short)), rows(p.score_vectors(df, short, 100))) == want
    table = spark.createDataFrame(list(enumerate(short)), "idx int, term string")
    assert (rows(p.question_tag_index(scored, table)), rows(p.score_vectors(df, table, 100))) == want


def test_a_hundred_thousand_tags(spark):
    tags = [f"t{i}" for i in range(100_000)]
    df = postings(spark)
    best = {r["question_id"]: (r["tag"], r["max_score"]) for r in p.question_max_score(df).collect()}
    want = sorted((q, int(t[1:]) * 50_000, y) for q, (t, y) in best.items() if t and t[0] == "t")
    got = p.score_vectors(df, tags, 50_000)
    assert rows(got) == want and got.schema["x"].dataType.typeName() == "long"
    assert p.score_vectors(df, tags[:1000], 50_000).schema["x"].dataType.typeName() == "integer"


def test_labels_of_a_long_list(spark):
    tags = [f"t{i}" for i in range(100_000)]
    df = spark.createDataFrame([(0,), (99_999 * 7,), (500 * 7 + 3,)], "x bigint").select(term_label("x", 7, tags).alias("t"))
    assert [r["t"] for r in df.collect()] == ["t0", "t99999", "t500"]


def test_literal_lists(spark):
    values = ["a,b", "\x01", "é", "\\E.*", "", "|", "\x02x"]
    assert spark.range(1).select(literal_strings(values).alias("v")).first()["v"] == values


def test_dictionary_of_a_table(spark):
    table = spark.createDataFrame([("a", 4), ("b", 1), ("a", 2), (None, 0)], "term string, idx int")
    assert rows(dictionary(spark, table), "term", "idx") == [("a", 2), ("b", 1)]
    assert rows(dictionary(spark, table.select("term"))) == [("a",), ("b",)]
    with pytest.raises(ValueError):
        dictionary(spark, ["a"] * 40)


def test_a_third_of_all_words_are_one_term(spark, monkeypatch):
    monkeypatch.setattr("termcluster.functions.dictionary.BROADCAST_BYTES", 1)
    df = spark.range(20_000, numPartitions=8).select("id", F.concat(F.lit("hot w"), F.col("id") % 5000).alias("text"))
    got = dict(ranking(m.rank_terms_grouped(df, ["hot", *LONG[:5000]])))
    assert got["hot"] == 20_000 and len(got) == 5001 and got["w17"] == 4
