import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import contamination, corpus, frame, letter_words
from termcluster.llm import suffix_decontamination as sd
from termcluster.llm.suffix_decontamination import decontaminate, items_digest
from termcluster.llm.textarrays import text_slices

ITEMS = "item_id long, text string"


def result(df):
    got = df.select("id", "n_words", "n_hit", F.size("items").alias("k"), items_digest(F.col("items")).alias("d"), "contaminated").collect()
    return sorted((tuple(r) for r in got), key=str)


def case(seed):
    rows = corpus(seed, n=70, vocabulary=120)
    r = random.Random(seed)
    items = []
    for k in range(25):
        w = letter_words(r.choice(rows)[1]) or ["x"]
        at = r.randrange(len(w))
        items.append((k, " ".join(w[at:at + r.choice([1, 3, 8, 13, 14, 30])]).title()))
    return rows, items + [(100, None), (101, ""), (102, "!!"), (None, items[3][1]), (7, items[5][1]), (103, "one"), (104, "never seen in any text at all " * 3)]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_equals_brute_force(spark, seed, block_bytes):
    rows, items = case(seed)
    rows += [(3, "another text with the id three"), (None, rows[8][1]), rows[10]]
    got = decontaminate(frame(spark, rows), spark.createDataFrame(items, ITEMS), block_bytes=block_bytes)
    assert result(got) == contamination(rows, items)


def test_longest_matches_and_rows(spark):
    words = [f"w{i}" for i in range(40)]
    rows = [(1, "start " + " ".join(words[5:30]) + " end"), (2, "nothing here")]
    for block_bytes in (1 << 20, 1):
        got = decontaminate(frame(spark, rows), spark.createDataFrame([(9, " ".join(words)), (8, "unused " * 20)], ITEMS), keep_row=True, block_bytes=block_bytes)
        first, second = sorted(got.collect(), key=lambda r: r.id)
        assert [m.asDict() for m in first.matches] == [{"item": "9", "start": 1, "length": 25}]
        assert first.n_hit == 25 and first.contaminated and first.row.text == rows[0][1]
        assert not second.contaminated and second.matches == []


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b c")], ITEMS)
    assert decontaminate(frame(spark, []), items).collect() == []
    got = decontaminate(frame(spark, [(1, "a b c"), (2, None)]), items.limit(0)).collect()
    assert sorted((r.id, r.n_words, r.n_hit, r.contaminated) for r in got) == [(1, 3, 0, False), (2, 0, 0, False)]


def brute_matches(text, items, size=13):
    """Spans of every item that are verbatim in it, at least a window long, and in no longer one."""
    w, out = letter_words(text), set()
    for item, t in items:
        v = letter_words(t)
        least, spans = min(size, len(v)), set()
        for a in range(len(w)):
            for b in range(len(v) if v else 0):
                n = 0
                while a + n < len(w) and b + n < len(v) and w[a + n] == v[b + n]:
                    n += 1
                if n >= least:
                    spans.add((a, a + n))
        out |= {(str(item), a, b - a) for a, b in spans if not any(c <= a and b <= d and (a, b) != (c, d) for c, d in spans)}
    return sorted(out)


@pytest.mark.parametrize("block_bytes", [1 << 20, 1])
def test_matches_are_verbatim(spark, block_bytes):
    far = [f"w{i}" for i in range(40)]
    items = [(1, "a b a"), (2, " ".join(far)), (3, "c " * 20), (4, " ".join(far[:20] + far[10:30]))]
    rows = [(1, "a b a b a"), (2, " ".join(far[20:36] + far[30:36] + far[:16])), (3, "c " * 24), (4, " ".join(far[:18] + far[5:25])), (5, "x " + " ".join(far[10:20] * 3)),
            (6, " ".join(far[:20] + far[8:30]))]
    got = decontaminate(frame(spark, rows), spark.createDataFrame(items, ITEMS), block_bytes=block_bytes).collect()
    for r in got:
        assert sorted((m.item, m.start, m.length) for m in r.matches) == brute_matches(dict(rows)[r.id], items)
    assert {tuple(m) for r in got if r.id == 1 for m in r.matches} == {("1", 0, 3), ("1", 2, 3)}


@pytest.mark.parametrize("window", [2, 5, 13])
def test_beginnings_lose_no_match(monkeypatch, window):
    """Hits against plain comparison, whatever the number of words of a beginning."""
    r = random.Random(window)
    texts = [" ".join(r.choice("abcd") for _ in range(r.randrange(60))) for _ in range(40)]
    items = [" ".join(r.choice("abcde") for _ in range(r.choice([0, 1, 2, 3, 4, 5, 14, 30]))) for _ in range(30)]
    items += [texts[k][2:40] for k in range(5)]
    expected = set()
    for k, t in enumerate(texts):
        v = t.split()
        for item in items:
            w = item.split()
            for a in range(max(len(w) - window, 0) + 1 if w else 0):
                size = len(w[a:a + window])
                expected |= {(k, p, size) for p in range(len(v) - size + 1) if v[p:p + size] == w[a:a + window]}
    for prefix in (1, 4, 13, 20):
        monkeypatch.setattr(sd, "PREFIX", prefix)
        tests = sd.Suffixes([str(k) for k in range(len(items))], pa.array(items), window)
        got = set()
        for part in text_slices(pa.array(texts), 300):
            _, text, start, length, _ = sd.shard_matches(part, tests, window)
            got |= set(zip((text + part.first).tolist(), start.tolist(), length.tolist(), strict=True))
        assert got == expected


def test_blocks_hold_every_item_once(spark):
    rows = [(k, f"item {k} " * 20) for k in range(50)]
    frame_of = spark.createDataFrame(rows + rows + [(1, None), (None, "no id")], ITEMS)
    for block_bytes in (1 << 20, 2000, 1):
        path, n = sd.item_blocks(frame_of, "item_id", "text", block_bytes)
        assert n == {1 << 20: 1, 2000: 5, 1: 51}[block_bytes] or (block_bytes == 2000 and n <= 6)
        names = [x for k in range(n) for x in sd.block_suffixes(path, k, 13).names]
        assert sorted(names, key=str) == sorted([*(str(k) for k in range(50)), None], key=str)
