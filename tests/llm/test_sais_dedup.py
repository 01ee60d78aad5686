import random

import numpy as np
import pytest

from tests.llm.brute import byte_repeats, corpus, frame
from termcluster.llm import sais_dedup
from termcluster.llm.sais_dedup import byte_dedup, repeated_starts, suffix_array


def naive(text):
    return sorted(range(len(text)), key=lambda i: text[i:])


def strings(seed):
    r = random.Random(seed)
    yield [1] * 50
    yield [1, 2] * 40
    yield [2, 1] * 40
    yield list(range(1, 60))
    yield list(range(60, 0, -1))
    for n in (1, 2, 3, 7, 40, 300):
        for k in (1, 2, 3, 30):
            yield [r.randint(1, k) for _ in range(n)]
    base = [r.randint(1, 4) for _ in range(100)]
    yield base + [9] + base + base[10:50]


def with_sentinel(values):
    """Consecutive values from 1 on, and the sentinel."""
    place = {v: i + 1 for i, v in enumerate(sorted(set(values)))}
    return [place[v] for v in values] + [0]


@pytest.mark.parametrize("most", [sais_dedup.NUMPY_BUCKETS, 0])
@pytest.mark.parametrize("seed", range(4))
def test_suffix_array_equals_sorting(seed, most, monkeypatch):
    monkeypatch.setattr(sais_dedup, "NUMPY_BUCKETS", most)
    for values in strings(seed):
        text = with_sentinel(values)
        assert suffix_array(np.array(text, np.int64)).tolist() == naive(text)


@pytest.mark.parametrize("seed", range(4))
def test_repeated_starts_equal_brute_force(seed):
    r = random.Random(seed)
    parts = [bytes(r.choice(b"ab") for _ in range(r.randrange(60))) for _ in range(12)] + [b"\xff\x00" * 20, b""]
    for length in (8, 11, 16):
        count: dict = {}
        for p in parts:
            for i in range(len(p) - length + 1):
                count[p[i:i + length]] = count.get(p[i:i + length], 0) + 1
        want = [count.get(p[i:i + length], 0) > 1 and i + length <= len(p) for p in parts for i in range(len(p))]
        got = repeated_starts(np.frombuffer(b"".join(parts), np.uint8), np.append(0, np.cumsum([len(p) for p in parts])), length)
        assert got.tolist() == want


def result(df):
    return sorted(((r.id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize("blocks_per_shard", [4000, 1])
def test_equals_brute_force(spark, blocks_per_shard):
    rows = corpus(1) + [(5, "again " * 60), (None, corpus(1)[7][1]), corpus(1)[3], (990, "日本語の文" * 40)]
    assert result(byte_dedup(frame(spark, rows), length=60, gram=12, blocks_per_shard=blocks_per_shard)) == byte_repeats(rows, 60)


def test_production_parameters_and_empty_table(spark):
    rows = corpus(3, n=50, longest=300)
    got = byte_dedup(frame(spark, rows))
    assert result(got) == byte_repeats(rows)
    assert all(len(r.kept) == r.n_bytes - r.n_removed for r in got.collect())
    assert byte_dedup(frame(spark, [])).collect() == []


def test_passage_with_many_surroundings_sends_few_bytes(spark, monkeypatch):
    """Blocks of one anchor are many here, but few of their strings repeat."""
    r = random.Random(5)

    def noise(n):
        return "".join(r.choice("abcdefgh") for _ in range(n))

    passage, sent = noise(50), spark.sparkContext.accumulator(0)
    texts = [noise(r.randrange(60, 90)) + passage + noise(r.randrange(60, 90)) for _ in range(300)]
    rows = list(enumerate(texts)) + [(1000 + i, texts[i][20:150] + noise(40)) for i in range(0, 300, 20)]
    shards = sais_dedup.shard_rows

    def counted(length):
        search = shards(length)

        def count(batches):
            for b in batches:
                sent.add(sum(map(len, b.column("bytes").to_pylist())))
                yield b

        return lambda batches: search(count(batches))

    monkeypatch.setattr(sais_dedup, "shard_rows", counted)
    assert result(byte_dedup(frame(spark, rows), length=60, gram=12, blocks_per_shard=10)) == byte_repeats(rows, 60)
    assert sent.value < sum(len(t) for _, t in rows)
