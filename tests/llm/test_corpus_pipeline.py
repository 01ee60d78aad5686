import random

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from tests.llm.brute import base_stats, components, contamination, corpus, frame, repeats  # noqa: E402


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with junk, copies, shared and benchmark passages."""
    d = tmp_path_factory.mktemp("sf")
    r = random.Random(5)
    rows = corpus(5, n=60, vocabulary=2000, longest=200)
    item = " ".join(f"bench{k}" for k in range(20))
    rows += [(300, " ".join(f"w{r.randrange(5000)}" for _ in range(60)) + " " + item), (301, " ".join(w + "$$$" for w in item.split()))]
    frame(spark, rows).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(0, item), (1, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d), dict(rows)


def test_every_stage_against_a_plain_version(spark, folder):
    d, _ = folder
    docs = spark.read.parquet(f"{d}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "ngram_jaccard_join", "substring_dedup", "benchmark_decontamination", "bpe_round_trip"]

    def texts(df):
        return {x.doc_id: x.text for x in df.collect()}

    before = texts(docs)
    docs = corpus_pipeline.scratch(stages["quality_rules"](spark, docs, d), "t")
    after = texts(docs)
    stats = {i: base_stats(t) for i, t in before.items()}
    assert all(stats[i][0] >= 10 and 100 * stats[i][4] <= 20 * stats[i][0] for i in after) and 301 not in after and 300 in after

    before, docs = after, corpus_pipeline.scratch(stages["ngram_jaccard_join"](spark, docs, d), "t")
    after = texts(docs)
    assert after == {i: before[i] for i, _, c in components(list(before.items())) if i == c}

    before, docs = after, corpus_pipeline.scratch(stages["substring_dedup"](spark, docs, d), "t")
    after = texts(docs)
    want = {i: n for i, _, n, _ in repeats(list(before.items()))}
    assert set(after) == set(before) and any(want.values())
    assert all(after[i] == before[i] if not n else len(after[i].split()) == len(before[i].split()) - n for i, n in want.items())

    before, docs = after, corpus_pipeline.scratch(stages["benchmark_decontamination"](spark, docs, d), "t")
    after = texts(docs)
    items = [(x.item_id, x.text) for x in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    assert after == {r[0]: before[r[0]] for r in contamination(list(before.items()), items) if not r[-1]} and 300 not in after

    got = stages["bpe_round_trip"](spark, docs, d).collect()
    assert {r.doc_id for r in got} == set(after) and all(r.round_trip and (r.n_tokens > 0) == bool(after[r.doc_id]) for r in got)


def test_run_gives_the_last_stage(spark, folder):
    d, texts = folder
    got = corpus_pipeline.run(spark, d).collect()
    assert 0 < len(got) < len(texts) and all(r.round_trip for r in got)


def test_join_stage_keeps_one_row_per_id(spark, folder):
    d, _ = folder
    docs = frame(spark, [(1, "one text that is there twice")] * 2 + [(2, "another text of the table")])
    got = dict(corpus_pipeline.STAGES)["ngram_jaccard_join"](spark, docs, d)
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == [1, 2]
