"""Property tests against plain-Python brute force on small random inputs."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from termcluster.operators import clustering, sampling
from termcluster.operators import mentions as m
from termcluster.params import ClusterParams
from termcluster.sources import postings as post_src
from termcluster.sources.postings import POSTING_SCHEMA

WORDS = ["Java", "Java,", "Scala", "scala", "the", "The", "C++", "", "x"]
SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

texts = st.lists(st.lists(st.sampled_from(WORDS), max_size=8).map(" ".join), min_size=0, max_size=12)
term_lists = st.lists(st.sampled_from(["Java", "Scala", "the", "The", "C++", "Cobol"]),
                      min_size=1, max_size=5, unique=True)


@SETTINGS
@given(texts, term_lists)
def test_rankings_match_brute_force(spark, docs, terms):
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    counts = Counter(t for d in docs for t in set(d.split(" ")) if t in terms)
    want_all = sorted(((t, counts.get(t, 0)) for t in terms), key=lambda r: (-r[1], r[0]))
    got_all = [(r["term"], r["n"]) for r in m.rank_terms_all(df, terms).orderBy("rnk").collect()]
    assert got_all == want_all
    got_grouped = [(r["term"], r["n"]) for r in m.rank_terms_grouped(df, terms).orderBy("rnk").collect()]
    got_index = [(r["term"], r["n"]) for r in
                 m.rank_terms_from_index(m.term_index(df, terms, block=3)).orderBy("rnk").collect()]
    assert got_grouped == got_index == [r for r in want_all if r[1] > 0]


posting_rows = st.lists(st.tuples(
    st.sampled_from([1, 2, 3]), st.integers(0, 10**12), st.none() | st.integers(0, 10**12),
    st.none() | st.integers(0, 10**12), st.integers(-2**31, 2**31 - 1),
    st.none() | st.sampled_from(["Java", "C#", '"C++"', "a b", "x;y"])), max_size=10)


@SETTINGS
@given(posting_rows)
def test_posting_lines_round_trip(spark, data):
    df = spark.createDataFrame(data, POSTING_SCHEMA)
    back = post_src.parse_postings(post_src.posting_lines(df))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(data, key=repr)


@SETTINGS
@given(st.integers(1, 4), st.integers(0, 10**6))
def test_sample_does_not_depend_on_layout(spark, k, seed):
    v = spark.range(300).selectExpr("id", "cast(id % 5 * 50000 as int) as x", "cast(id % 97 as int) as y")
    a = rows(sampling.sample_per_stratum(v, k, seed), "x", "id")
    b = rows(sampling.sample_per_stratum(v.repartition(5), k, seed), "x", "id")
    assert a == b and len(a) == 5 * k


def test_global_sample_path_when_strata_are_close(spark):
    """spread < 500: centres come from a global sample of `kernels` rows."""
    data = [(1, q, None, None, 0, "Java" if q % 2 else "Scala") for q in range(1, 41)]
    data += [(2, 1000 + q, None, q, (q * 37) % 50, None) for q in range(1, 41)]
    postings = spark.createDataFrame(data, POSTING_SCHEMA)
    params = ClusterParams(terms=("Java", "Scala"), spread=100, kernels=4, max_iterations=50)
    run = clustering.cluster_questions(postings, params)
    assert len(run.initial) == 4
    report = run.report().collect()
    assert sum(r["size"] for r in report) == 40
    assert {r["label"] for r in report} <= {"Java", "Scala"}


def test_sorted_vectors_option(spark):
    from termcluster.operators.postings import score_vectors
    data = [(1, 1, None, None, 0, "Scala"), (2, 2, None, 1, 5, None),
            (1, 3, None, None, 0, "Java"), (2, 4, None, 3, 6, None)]
    df = spark.createDataFrame(data, POSTING_SCHEMA)
    xs = [r["x"] for r in score_vectors(df, ("Java", "Scala"), 10, sort=True).collect()]
    assert xs == sorted(xs)


def test_kernels_must_divide_by_terms_on_both_sampling_paths(spark):
    import pytest
    data = [(1, 1, None, None, 0, "Java"), (2, 2, None, 1, 5, None)]
    postings = spark.createDataFrame(data, POSTING_SCHEMA)
    for spread in (50000, 100):
        with pytest.raises(ValueError):
            clustering.prepare(postings, ClusterParams(terms=("Java", "Scala"), spread=spread, kernels=3))
