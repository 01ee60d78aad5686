import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.brute import corpus, frame
from tests.llm.test_bpe_rounds import odd_texts
from termcluster.llm.streamvbyte_output import PieceEncoder, read_token_ids, token_id_round_trip, vbyte_decode, vbyte_encode, write_token_ids

PATH = public_tokenizers.path("word_bpe_49k.json")


def library():
    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def expected(rows):
    encode, out, start = library(), [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*encode(t), 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[1])


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 1000])
def test_coding_round_trip(n):
    r = np.random.default_rng(n)
    v = (r.integers(0, 1 << 32, n, dtype=np.uint64) >> r.integers(0, 32, n, dtype=np.uint64)).astype(np.uint32)
    assert (vbyte_decode(*vbyte_encode(v), n) == v).all()


def test_pieces_equal_whole_texts():
    encoder, encode = PieceEncoder(PATH), library()
    assert encoder.cached
    texts = odd_texts(7) + ["<|startoftext|>Ab <|endoftext|>", "ΑΣ ΣΑΣ. İ ǅ", "é ́e", "a b\x85c d"]
    raw = [t.encode() for t in texts]
    ids, bounds = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(x) for x in raw])))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [encode(t) for t in texts]


def test_files_give_the_library_ids_in_order(spark):
    rows = corpus(6) + [(1000 - i, t) for i, t in enumerate(odd_texts(3)[:40])] + [(None, "no id at all")]
    random.Random(1).shuffle(rows)
    for block_ids in (1 << 18, 50):
        assert result(token_id_round_trip(frame(spark, rows, 5), PATH, block_ids=block_ids)) == expected(rows)


def test_empty_table_repeated_ids_and_ranks(spark, tmp_path):
    assert token_id_round_trip(frame(spark, []), PATH).collect() == []
    rows = [(1, "a b"), (1, "a b"), (1, None), (0, "a a a a")]
    path = write_token_ids(frame(spark, rows), f"file://{tmp_path}/ids", PATH)
    got = result(read_token_ids(spark, path))
    assert [r[0] for r in got] == [0, 1, 1, 1] and [r[1] for r in got[:2]] == [0, 5] and got[-1][1] + got[-1][2] == 12
    ranks = {r["rank"]: r.k for r in spark.read.parquet(path + "/ranks").collect()}
    assert [ranks[k] for k in sorted(ranks)] == sorted(ranks.values(), reverse=True)


def test_every_plain_character_as_the_library():
    """Characters that are cut without the library, next to letters, digits, signs and suffixes."""
    encode, encoder = library(), PieceEncoder(PATH)
    assert encoder.cached
    plain = [chr(c) for c in range(0x21, 0x250) if encoder.PLAIN(chr(c))]
    assert len(plain) > 300 and not encoder.PLAIN("İ") and not encoder.PLAIN("\xa0") and not encoder.PLAIN("á")
    texts = [t for c in plain for t in (f"a{c}b", f"{c}{c} É{c}", f"1{c}2 {c}'s", f"ß{c}'ll,{c}.")]
    data, ends = np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0, *(len(t.encode()) for t in texts)])
    ids, bounds = encoder.encode(data, ends)
    for k, t in enumerate(texts):
        assert ids[bounds[k]:bounds[k + 1]].tolist() == encode(t), t


@pytest.mark.parametrize("top", [0xFF, 0x100, 0xFFFF, 0x10000])
@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 1001])
def test_coding_of_narrow_and_wide_values(top, n):
    values = np.random.default_rng(n).integers(0, top + 1, n).astype(np.uint32)
    values[:1] = top
    control, data = vbyte_encode(values)
    assert len(control) == -(-n // 4) and len(data) == sum((int(v).bit_length() + 7) // 8 or 1 for v in values)
    assert (vbyte_decode(control, data, n) == values).all()
