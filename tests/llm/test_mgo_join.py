import random

import pytest

from termcluster.llm.components import components
from termcluster.llm.mgo_join import component_survivors, jaccard_components
from tests.llm.brute import components as brute_components
from tests.llm.brute import corpus, frame


def result(df):
    return sorted((r.id, r.n_shingles, r.component_id) for r in df.collect())


def near_group(seed=5, copies=40, words=120):
    """Copies with more or fewer edits: some link only by way of others."""
    r = random.Random(seed)
    base = [f"w{r.randrange(10**6)}" for _ in range(words)]
    rows = []
    for i in range(copies):
        ws = base[:]
        for _ in range(r.randrange(7)):
            ws[r.randrange(words)] = f"e{r.randrange(10**6)}"
        rows.append((1000 + i, " ".join(ws)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed, n=90) + near_group(seed)
    r = random.Random(seed)
    rows = [(i, t.upper() if r.random() < 0.1 and t else t) for i, t in rows]
    assert result(jaccard_components(frame(spark, rows))) == brute_components(rows)


def test_tokens_spread_over_parts(spark):
    rows = near_group(9, copies=60) + [(i, "the same short line of words here") for i in range(30)]
    want = brute_components(rows)
    assert result(jaccard_components(frame(spark, rows), rows_per_part=4)) == want


def test_empty_table_null_ids_and_repeated_rows(spark):
    assert jaccard_components(frame(spark, [])).collect() == []
    text = "a b c d e f g h"
    rows = [(None, text), (2, text), (2, text), (3, text), (4, None), (5, "")]
    got = {(r.id, r.n_shingles, r.component_id) for r in jaccard_components(frame(spark, rows)).collect()}
    assert got == {(None, 4, None), (2, 4, 2), (3, 4, 2), (4, 0, 4), (5, 0, 5)}
    assert sorted((r.doc_id for r in component_survivors(frame(spark, rows)).collect()), key=str) == [2, 2, 4, 5, None]


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 100 + k) for k in range(1, 40)] + [(7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(31)} | {100 + k: 100 for k in range(40)}


def test_one_row_per_id(spark):
    text, other = "a b c d e f g h", "b other words under the same id here"
    rows = [(None, text), (None, text), (2, text), (2, text), (3, text), (4, None), (4, None), (5, ""), (7, other), (7, "k l m n o p q"), (8, "not repeated at all")] + [(9, "hot id text")] * 50
    want = [(2, text), (4, None), (5, ""), (7, other), (8, "not repeated at all"), (9, "hot id text"), (None, text), (None, text)]
    for parts in (1, 4):
        got = component_survivors(frame(spark, rows, parts), one_per_id=True).collect()
        assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(want, key=str)


def test_survivors_keep_columns_in_any_order(spark):
    """doc_id needn't be the first column."""
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (3, "x y z"), (3, "x y w"), (None, "q")]
    docs = frame(spark, rows).select("text", "n_chars", "doc_id")
    for one, ids in ((False, [None, 1, 3, 3]), (True, [None, 1, 3])):
        got = component_survivors(docs, one_per_id=one)
        assert got.columns == docs.columns
        assert sorted((r.doc_id for r in got.collect()), key=lambda i: (i is not None, i)) == ids
        assert all(r.n_chars == len(r.text) for r in got.collect())
