import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer, pre_tokenizers

from tests.llm.brute import corpus, frame
from termcluster.llm.bpe_rounds import Vocabulary, bpe_round_trip, encode, merge_long
from termcluster.llm.pretokens import Splitter, odd_characters

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts(seed=1):
    r = random.Random(seed)
    alphabet = "abcdeABC   \n\t'0123456789.,!?#é日本語🙂́  \x00<|>" + "aaaa"
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(80))) for _ in range(300)]
    texts += ["a" * 1000, "ab" * 700, "!" * 600, " " * 500, "\n" * 300 + "x", "it's we'll I'd", "<|endoftext|>", "x<|endoftext|><|endoftext|> y",
              "<|endoftext", "".join(chr(r.randrange(32, 0x3000)) for _ in range(2000)), "".join(r.choice("abcdefghij") for _ in range(5000))]
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_ids_equal_the_library(library, seed):
    texts = odd_texts(seed) + [t for _, t in corpus(seed) if t]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in encode(PATH, texts)] == want


def test_rounds_and_heap_agree():
    v = Vocabulary(PATH)
    for word in ("aaaaaaa", "hello", "ababababab", "international", "zzzzzzzzzzzzzzzz"):
        assert merge_long(v, v.byte_id[list(word.encode())].tolist()) == encode(PATH, [word])[0].tolist()


def test_round_trip_through_spark(spark, library):
    rows = corpus(4, n=30) + [(500 + i, t) for i, t in enumerate(odd_texts(4)[-12:])] + [(None, "no id"), (1, "again")]
    got = bpe_round_trip(frame(spark, rows), PATH, keep_row=True).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = library.encode(r.row.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert r.ids == ids and r.n_tokens == len(ids) and r.decoded == text
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table(spark):
    assert bpe_round_trip(frame(spark, []), PATH).collect() == []


def test_every_code_point_is_cut_as_the_library_cuts_it():
    cut = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    split = Splitter(odd_characters())
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    for k in range(0, len(points), 1024):
        text = "".join(f"a{chr(c)}'s {chr(c)}'s" for c in points[k:k + 1024])
        assert split(text) == [text[a:b] for _, (a, b) in cut(text)]


def test_ids_of_characters_newer_than_the_library(library):
    odd = list("\u0558\u088f\u0c5c\U000323b0")
    texts = [f"a{c}'s {c}'s 1{c}1 {c}{c} {c}!" for c in odd]
    assert [x.tolist() for x in encode(PATH, texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
