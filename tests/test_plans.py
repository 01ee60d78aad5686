"""Physical-plan properties and the DuckDB oracle for every query."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import TABLES, rows_key
from termcluster.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                "PythonMapInArrow", "MapInArrow")

# Queries that run the k-means loop while being planned (slow to plan twice).
LOOPING = {"kmeans", "cluster_report", "cluster_report_mixed", "cluster_report_text"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - LOOPING))
def test_no_python_on_the_data_path(spark, name):
    p = plan(QUERIES[name](spark, SF))
    assert not any(n in p for n in PYTHON_NODES), p


def test_documents_scan_reads_text_only(spark):
    p = plan(QUERIES["rank_terms_grouped"](spark, SF))
    assert "ReadSchema: struct<text:string>" in p


def test_postings_scans_are_pruned(spark):
    p = plan(QUERIES["score_vectors"](spark, SF))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderpriority:string>" in p
    # the answer id is not needed for the vectors, so l_linenumber is pruned too
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in p
    assert "l_shipdate" not in p


def test_rank_all_needs_no_join(spark):
    p = plan(QUERIES["rank_terms_all"](spark, SF))
    assert "Join" not in p and "partial_sum" in p


def test_best_score_needs_no_join(spark):
    p = QUERIES["question_max_score"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in p and "Aggregate [question_id" in p, p


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["label", "percent", "size", "median"]
    assert df.count() > 0


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_duckdb(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    srows = df.collect()
    rel = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    idx = [rel.columns.index(c) for c in df.columns]
    orows = [tuple(r[i] for i in idx) for r in rel.fetchall()]
    assert len(srows) == len(orows)
    assert rows_key(srows) == rows_key(orows)


def test_every_query_of_the_inventory_has_an_oracle():
    assert set(entry.QUERIES) <= set(entry.oracle_sql())


def _partial_before_exchange(plan_text, partial_fn):
    """True when a partial aggregate of ``partial_fn`` is the input of an Exchange."""
    lines = plan_text.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" not in line:
            continue
        below = [ln for ln in lines[i + 1:] if not any(skip in ln for skip in ("InputAdapter", "Project", "ShuffleQueryStage"))]
        if below and "Aggregate" in below[0] and partial_fn in below[0]:
            return True
    return False


@pytest.mark.parametrize("name,partial", [
    ("rank_terms_grouped", "partial_count"),
    ("question_max_score", "partial_max"),
    ("score_vectors", "partial_max"),
    ("cluster_sizes", "partial_sum"),
    ("cluster_median", "partial_sum"),
])
def test_hot_keys_are_pre_aggregated(spark, name, partial):
    """A key holding a third of all rows must be collapsed map-side."""
    p = plan(QUERIES[name](spark, SF))
    assert _partial_before_exchange(p, partial), p


def test_report_computes_the_nearest_centres_once(spark):
    df = QUERIES["cluster_report"](spark, SF)
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "percentile" not in p and "ReusedExchange" in p, p


def test_kmeans_leaves_nothing_cached(spark):
    def persisted():
        return set(spark.sparkContext._jsc.getPersistentRDDs().keySet())
    before = persisted()
    for name in ("kmeans", "cluster_report", "cluster_means", "assign_nearest"):
        QUERIES[name](spark, SF).collect()
        assert persisted() <= before


def test_point_partitions_grow_with_the_points(spark):
    from termcluster.operators import kmeans as km
    vectors = spark.range(1000).selectExpr("int(id) AS x", "int(id) AS y")
    points = km.checkpointed_points(vectors, points_per_task=20)
    assert points.rdd.getNumPartitions() == 50 > spark.sparkContext.defaultParallelism


def test_kmeans_step_shape(spark):
    """A step: the bands' columns alone, a join with the intervals, a partial
    aggregate, one exchange, and a final aggregate read by one task."""
    from termcluster.operators.clustering import prepare
    from termcluster.operators import kmeans as km
    from termcluster.plans.catalog import POSTING_PARAMS
    from termcluster.sources import tables
    run = prepare(tables.postings(spark, SF), POSTING_PARAMS)
    step = km.step_means(run.points, run.initial, run.lines)
    p = plan(step)
    assert "Coalesce 1" in p and "partial_sum" in p and "BroadcastHashJoin" in p and "transform(" not in p
    assert p.count("Exchange hashpartitioning") == 1
    assert step.rdd.getNumPartitions() == 1


def test_a_step_reads_the_bands_that_it_needs(spark):
    from termcluster.operators import kmeans as km
    vectors = spark.range(4000).selectExpr("int(id % 2 * 1000) AS x", "int(id) AS y")
    points, lines = km.banded_points(vectors, points_per_task=100)
    assert points.select("band").distinct().count() == 1 + max(x.band_of(x.most) for x in lines.values()) > 30
    assert max(r["count"] for r in points.groupBy("band").count().collect()) <= 100
    sums = km.ClusterSums(points, lines, 2)
    sums.bands.append(0)
    read = sums.read([(0, 130, 170, 7)], ["c"])
    assert sums.bands == [1] and read.count() == 21
    p = plan(read)
    assert "band" in p.split("PartitionFilters: [")[1].split("]")[0], p
